"""Named queries over the supplied tables, and the SQL that must give the same rows."""
