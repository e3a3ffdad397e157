"""Column expressions: casts, code lists, decoders and name parsing."""
