"""Readers of records and the store of graphs."""
