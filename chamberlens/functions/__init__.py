"""Column expressions and distributed order statistics shared by the operators."""
