"""Flight-data analytics as Spark DataFrame and Structured Streaming jobs."""
