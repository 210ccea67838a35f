"""Whole jobs, the star-schema views and the registered queries."""
