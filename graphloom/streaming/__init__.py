"""Folders as they arrive."""
