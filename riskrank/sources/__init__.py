"""Reading landed files and tables, writing results, and looking up tables."""
