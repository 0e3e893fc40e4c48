"""Job-run analytics as Spark DataFrame and Structured Streaming transformations."""
