"""Continuous form of the per-period refresh."""
