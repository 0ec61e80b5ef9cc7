"""Column expressions: no DataFrame, no job."""
