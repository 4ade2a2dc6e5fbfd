"""Queries over the generated tables, and the SQL that must give the same rows."""
