"""Column expressions and column-name rules."""
