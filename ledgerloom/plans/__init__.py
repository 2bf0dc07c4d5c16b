"""Whole jobs, and the query catalogue over the sample tables."""
