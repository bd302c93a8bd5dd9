"""Registered queries: each runs an operator over the star tables, with the SQL to match."""
