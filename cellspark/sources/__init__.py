"""Readers and writers of observation tables, grids and cell documents."""
