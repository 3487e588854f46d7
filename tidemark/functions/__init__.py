"""Column expressions, distributed order statistics and tail probabilities."""
