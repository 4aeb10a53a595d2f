"""Column expressions: dates and trading periods, text, numbers."""
