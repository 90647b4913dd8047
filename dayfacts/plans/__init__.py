"""Composite plans: dimensions, facts, and the registered queries with their SQL."""
