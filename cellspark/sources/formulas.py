"""Inventories of formulas held as rows: functions, references, shapes and kinds, by regular expressions in Columns.

This is not a parser: formulas are evaluated from (cell, shape, operands) rows
(plans.levels). These functions sort a workbook's formulas into shapes, so that
cells filled down from one formula become one shape, and tell which formulas
need attention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFERENCE = r"(?:'(?:\[\d+\])?[^'\[\]]+'!|(?:\[\d+\])?[\p{L}_][\p{L}\d_]*!)?\$?[A-Z]{1,3}\$?\d+(?::\$?[A-Z]{1,3}\$?\d+)?"
FUNCTION = r"(?:_xlfn\.)?([A-Z][A-Z0-9.]*)\("
TEXT = r'"(?:[^"]|"")*"'
#: Functions that have an equivalent here.
SUPPORTED = ("AND", "AVERAGEIFS", "COUNTA", "COUNTIF", "COUNTIFS", "FIND", "HLOOKUP", "IF", "IFERROR", "INDEX", "ISNUMBER", "LEFT", "LEN", "MATCH", "MAX", "MOD", "N", "NUMBERVALUE", "QUOTIENT", "RANK", "RIGHT", "ROUND", "ROW", "SUBSTITUTE", "SUM", "SUMIFS", "SUMPRODUCT", "TEXT", "VLOOKUP")


def bare(formula: Column) -> Column:
    """A formula without the contents of its texts."""
    return F.regexp_replace(formula, TEXT, '""')


def functions_used(formula: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(bare(formula), F.lit(FUNCTION), 1)))


def unsupported(formula: Column) -> Column:
    """The functions of a formula that nothing here stands for."""
    return F.array_except(functions_used(formula), F.array(*map(F.lit, SUPPORTED)))


def references(formula: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(formula, TEXT, '""'), F.lit(f"({REFERENCE})"), 1)


def shape(formula: Column) -> Column:
    """A formula with @ for references, # for numbers and $ for texts."""
    s = F.regexp_replace(formula, TEXT, "\u0001")
    s = F.regexp_replace(s, REFERENCE, "@")
    s = F.regexp_replace(s, r"(?<![A-Z@])\d+(\.\d+)?", "#")
    return F.regexp_replace(s, "\u0001", F.lit(r"\$"))


def is_anchor(formula: Column, sheet: str, ref: str = "A1") -> Column:
    """Whether a formula is nothing but a reference to the base year's seat in another workbook."""
    return F.regexp_replace(formula, r"\$", "").rlike(rf"^='?\[\d+\]{sheet}'?!{ref}$")


def kind(formula: Column, marker: str) -> Column:
    """expr, unsupported, or presentation: what a page shows rather than computes, by a marker and without external references."""
    external = formula.rlike(r"\[\d+\]")
    return F.when(formula.contains(marker) & ~external, "presentation").when(F.size(unsupported(formula)) > 0, "unsupported").otherwise("expr")


def areas(text: Column, host: Column) -> Column:
    """array<struct<sheet, r1, c1, r2, c2>> of a chart's range, a list of ranges in brackets or one; a range without a sheet is on the host's."""
    from .tables import coordinates

    def area(x: Column) -> Column:
        sheet = F.regexp_replace(F.regexp_extract(x, r"^(.*)!", 1), r"^'|'$", "")
        a, b = F.regexp_extract(x, r"([^!:]+)(?::|$)", 1), F.regexp_extract(x, r":(.+)$", 1)
        last = F.when(b == "", a).otherwise(b)
        (r1, c1), (r2, c2) = coordinates(a), coordinates(last)
        return F.struct(F.when(sheet == "", host).otherwise(sheet).alias("sheet"), F.least(r1, r2).alias("r1"), F.least(c1, c2).alias("c1"), F.greatest(r1, r2).alias("r2"), F.greatest(c1, c2).alias("c2"))

    return F.transform(F.split(F.regexp_replace(text, r"^\(|\)$", ""), ","), area)


def shapes(formulas: DataFrame) -> DataFrame:
    """shape, n, sample of formulas(formula), the most frequent first."""
    return formulas.groupBy(shape(F.col("formula")).alias("shape")).agg(F.count("*").alias("n"), F.min("formula").alias("sample")).orderBy(F.desc("n"), "shape")
