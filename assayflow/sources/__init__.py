"""Reading and writing tables, fitted state and named intermediate results."""
