"""Whole flows: loads, the daily refresh and the read queries."""
