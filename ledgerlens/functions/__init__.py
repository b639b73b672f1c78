"""Column expressions and calendar arithmetic."""
