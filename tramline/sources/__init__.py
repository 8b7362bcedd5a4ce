"""Feeds, snapshots, tables and sinks."""
