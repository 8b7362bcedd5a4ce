"""Arrival predictions: checks, routing and the streaming query."""
