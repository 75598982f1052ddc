"""Column expressions: Column in, Column out, no UDF unless Spark has no built-in."""
