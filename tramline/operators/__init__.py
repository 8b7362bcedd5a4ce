"""Cleaning, quality, profiling and dimensional operators."""
