"""Registered queries: each operator on inputs derived from the given tables, with its SQL."""
