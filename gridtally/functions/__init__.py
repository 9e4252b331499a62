"""Column expressions; all of them Spark built-ins."""
