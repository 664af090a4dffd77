"""Refreshing observation tables from files as they arrive."""
