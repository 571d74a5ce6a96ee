"""Column expressions shared by the jobs; all built from Spark's own functions."""
