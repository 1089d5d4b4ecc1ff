"""Reusable DataFrame operators: de-duplication, keys, lookups, filters, inserts."""
