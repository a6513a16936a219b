"""Column-to-column functions; all of them compile to native Spark expressions."""
