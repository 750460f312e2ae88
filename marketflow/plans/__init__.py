"""Report jobs and the query catalog."""
