"""Keyed tables, SQL access and sinks."""
