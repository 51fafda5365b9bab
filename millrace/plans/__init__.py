"""SQL scripts and tasks."""
