"""Relational operators: conform, quality, history (SCD2), marts, joins, reports, nested."""
