"""Column expressions.  All built-in Spark functions, so they stay in generated code."""
