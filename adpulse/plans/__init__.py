"""Whole jobs: read, measure, write."""
