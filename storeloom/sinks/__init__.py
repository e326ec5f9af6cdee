"""Table and warehouse writers."""
