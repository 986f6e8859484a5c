"""Queries over the given tables, their SQL oracles, and the comparison between the two."""
