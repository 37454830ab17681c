"""Incremental load of newly landed feeds."""
