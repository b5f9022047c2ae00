"""Column expressions: text in, typed columns out. No Python runs on the rows."""
