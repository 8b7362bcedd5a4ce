"""Loads, reports and queries built from the operators."""
