"""Price-list and sensor analytics written as Spark DataFrame jobs."""
