"""Column expressions that loads and checks are made of."""
