"""Queries over the shared tables, each next to the SQL that must give the same rows."""
