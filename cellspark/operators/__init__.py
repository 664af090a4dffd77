"""Operators on tables of observations, grids and cells."""
