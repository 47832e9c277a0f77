"""Reading documents and writing results."""
