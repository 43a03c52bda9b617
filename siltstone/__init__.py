"""Event lakehouse operators for PySpark: JSON event files to analytics tables."""
