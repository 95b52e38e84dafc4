"""Column expressions: everything here takes and returns Spark columns."""
