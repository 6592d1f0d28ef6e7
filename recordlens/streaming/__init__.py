"""Incremental runs over file drops."""
