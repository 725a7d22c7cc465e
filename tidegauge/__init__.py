"""Data-flow tracking for large shared file systems, as Spark DataFrame plans."""
