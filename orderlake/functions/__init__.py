"""Column expressions with the semantics the plans rely on."""
