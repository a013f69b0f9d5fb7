"""Column expressions and column-wise frame steps."""
