"""Governance metadata derived from the given star-schema tables, for tests and benchmarks."""
