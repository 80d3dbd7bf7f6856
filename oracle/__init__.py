"""Independent SQL for every query, run by another engine on the same tables."""
