"""Column functions over text, and their names in SQL."""
