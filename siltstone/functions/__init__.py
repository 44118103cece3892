"""Column expressions: text cleaning, tolerant parsing, business metrics."""
