"""Column expressions: they take and return columns and never look at data."""
