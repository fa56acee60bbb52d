"""Growing-season analytics as set-wise PySpark jobs."""
