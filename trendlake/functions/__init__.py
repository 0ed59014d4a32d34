"""Column expressions and schema helpers; all built on Spark's own functions."""
