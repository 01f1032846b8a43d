"""Whole jobs, and the queries checked against plain SQL."""
