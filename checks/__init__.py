"""Queries over the generated tables and the SQL they are compared with."""
