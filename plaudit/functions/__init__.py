"""Column expressions: exact rounding, text normalisation, rule chains, digests."""
