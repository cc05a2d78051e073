"""Writing results, run metrics and comparison tables."""
