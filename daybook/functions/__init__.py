"""Column expressions; all built in, none a Python UDF."""
