"""Writers for micro-batches, rows and messages."""
