"""Operators on tables of records, candidates and scores."""
