"""Readers: every reader returns one lazy DataFrame over all landed files."""
