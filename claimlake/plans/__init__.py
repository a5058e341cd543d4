"""Composed jobs, driver stand-in tables, registered queries and their SQL oracles."""
