"""Whole jobs, from stored tables to stored tables."""
