"""Column -> Column functions. All are built-in expressions; null in gives null out."""
