"""Column functions: text normalisation and string similarity."""
