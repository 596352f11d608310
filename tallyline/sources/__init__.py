"""JSON landing tables, their schemas, and the sinks."""
