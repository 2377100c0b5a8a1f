"""Column expressions: text, dates, URL rules, vectors."""
