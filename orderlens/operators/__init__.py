"""Distributed building blocks: lookups, rank selection, stored results."""
