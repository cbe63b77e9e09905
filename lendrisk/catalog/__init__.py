"""The named queries over the provided tables, and the SQL they are checked against."""
