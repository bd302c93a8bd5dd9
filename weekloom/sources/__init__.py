"""Readers, writers, schemas and the mapping of star-schema tables to retail roles."""
