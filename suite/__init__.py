"""Check queries over the given test tables, each beside its SQL."""
