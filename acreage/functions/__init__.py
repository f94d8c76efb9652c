"""Column expressions: no UDF, so all of them stay in generated code."""
