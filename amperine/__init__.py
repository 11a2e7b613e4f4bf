"""Three-phase power telemetry analytics on Spark DataFrames."""
