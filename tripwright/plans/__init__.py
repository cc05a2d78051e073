"""Operators put together: the pipelines, the test-table derivations and the query list."""
