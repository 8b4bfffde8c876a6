"""Column functions: each takes and returns a `Column` of built-in expressions."""
