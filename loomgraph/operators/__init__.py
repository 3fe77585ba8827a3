"""Operators on records, bindings and graphs; each takes and returns DataFrames."""
