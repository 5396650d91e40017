"""Reading and writing files."""
