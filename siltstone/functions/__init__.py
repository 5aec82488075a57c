"""Column expressions: everything here is built from Spark's own functions."""
