"""Composite jobs (medallion run), the test-table adapter and the query catalogue."""
