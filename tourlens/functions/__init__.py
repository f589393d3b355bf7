"""Column expressions: text keys, name normalisation, dates."""
