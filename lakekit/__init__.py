"""lakekit: warehouse-style analytics as PySpark DataFrame, SQL and streaming jobs."""
