"""Registered queries: test-table roles, Spark plans and their SQL checks."""
