"""Column expressions for dirty text, dates and price ratios."""
