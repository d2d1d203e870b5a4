"""Whole jobs composed from the operators for one table configuration."""
