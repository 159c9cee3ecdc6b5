"""Column expressions: change text, cells, type labels, envelopes, LSNs."""
