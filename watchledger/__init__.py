"""Security incident and login analytics as PySpark DataFrame jobs."""
