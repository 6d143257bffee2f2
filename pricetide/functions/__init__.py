"""Column expressions; everything here stays inside Spark's code generation."""
