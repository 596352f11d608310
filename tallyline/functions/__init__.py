"""Column functions shared by the reports and the ingest jobs."""
