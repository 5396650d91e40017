"""Registered queries: each runs library operators over the given tables."""
