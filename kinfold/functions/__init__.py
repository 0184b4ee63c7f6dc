"""Column functions: text views, terms, similarities."""
