"""Metric tables that can be written again without duplicates."""
