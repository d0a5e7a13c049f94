"""Column expressions and driver-side descriptions of schemas and dialects."""
