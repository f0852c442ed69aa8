"""Readers for delimited text, drifting file sets and file listings."""
