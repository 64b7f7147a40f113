"""Aggregates, windows, joins, rolling means and change merges."""
