"""Reading and writing JSON lines."""
