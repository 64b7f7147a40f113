"""Readers for tables, file and line streams, message envelopes and replayed batches."""
