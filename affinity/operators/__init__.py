"""Relational operators of the pairwise-connectivity analyses."""
