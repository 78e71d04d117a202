"""Column expressions: times, texts, amounts."""
