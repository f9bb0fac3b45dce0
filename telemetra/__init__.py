"""Vehicle-terminal telemetry metrics as Spark DataFrame and Structured Streaming jobs."""
