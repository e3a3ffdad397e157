"""Whole jobs, and the queries the driver checks."""
