"""Column functions with the semantics of spreadsheet formulas."""
