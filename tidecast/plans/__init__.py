"""Plan building blocks that keep operators balanced on skewed data."""
