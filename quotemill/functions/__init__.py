"""Column expressions and schema-level helpers."""
