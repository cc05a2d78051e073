"""Reading trips, zones, results, run metrics and resource logs."""
