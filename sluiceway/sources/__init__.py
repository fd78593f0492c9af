"""Reading and generating rows."""
