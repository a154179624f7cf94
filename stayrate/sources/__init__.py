"""Reading and writing tables and models."""
