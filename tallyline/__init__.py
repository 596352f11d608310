"""Contact-centre usage analytics as Spark DataFrame and streaming jobs."""
