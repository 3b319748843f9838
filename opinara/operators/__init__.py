"""Relational operators on a review table."""
