"""Whole jobs and the named queries over their result tables."""
