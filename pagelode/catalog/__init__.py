"""Named queries over the standard tables and the SQL each one is checked against."""
