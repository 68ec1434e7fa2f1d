"""Column expressions; all are built from Spark's own functions."""
