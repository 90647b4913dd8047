"""Owned schemas, table scans, and documents turned into rows."""
