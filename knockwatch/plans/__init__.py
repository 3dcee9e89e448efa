"""Whole jobs, and the views and queries over the benchmark tables."""
