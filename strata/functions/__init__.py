"""Column expressions: calendar parts, exact fixed-point aggregation, statistics."""
