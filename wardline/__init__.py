"""Governance analytics as plain Spark DataFrame transformations."""
