"""Column functions: timestamp parsing, date/time keys, fixed rule values."""
