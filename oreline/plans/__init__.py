"""Whole jobs: Silver, Gold, daily load, and the analytical queries."""
