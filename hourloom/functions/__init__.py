"""Column expressions: no joins, no shuffles, no Python on the data path."""
