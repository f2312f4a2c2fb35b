"""Column expressions: cleaning, scoring, labels, statistics."""
