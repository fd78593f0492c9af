"""Writing rows."""
