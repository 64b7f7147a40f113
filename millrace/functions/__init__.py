"""Column-level functions; all of them are plain Spark expressions."""
