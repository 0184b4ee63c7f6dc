"""Entity resolution over business records, as Spark DataFrame operations."""
