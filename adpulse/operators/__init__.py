"""Selections, counts, rates, changes and unions over event frames."""
