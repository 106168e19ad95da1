"""Literature-corpus pipeline as PySpark DataFrame operations."""
