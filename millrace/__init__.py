"""Reusable DataFrame transforms for tables and event streams.

Every transform takes and returns DataFrames and works the same on static and
streaming input; only the runtime in :mod:`millrace.streaming` starts queries.
"""
