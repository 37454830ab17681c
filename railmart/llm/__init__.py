"""Operators for preparing training text, their registered queries and SQL."""
