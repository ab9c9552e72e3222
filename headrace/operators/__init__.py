"""Table-level work."""
