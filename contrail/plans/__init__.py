"""Whole jobs, the adapter views and the query catalogue."""
