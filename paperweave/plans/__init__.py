"""The data jobs, end to end."""
