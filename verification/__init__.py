"""Checks over the provided tables: fixture views, registered queries and their SQL twins."""
