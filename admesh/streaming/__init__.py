"""Results kept up to date from streams."""
