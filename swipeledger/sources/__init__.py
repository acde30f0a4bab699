"""Readers and temp views."""
