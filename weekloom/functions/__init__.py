"""Column expressions and small aggregate patterns shared by the operators."""
