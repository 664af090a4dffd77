"""Criterion strings (">=25", "<>x", "=", "text") and the predicates that they mean on three kinds of columns.

Long tables: texts compare without regard to ASCII case, a numeric right side
compares the number that a text begins with, and null rows never match `<>`.
Sparse grids and pages: a blank cell matches `<>x`; numbers and texts are kept
apart. On every path `=` alone means blank and `<>` alone not blank.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import NUMBER, ascii_fold, fifteen_digits, general_number, number_prefix, text_number, unescape

PATTERN = r"^(<>|>=|<=|>|<|=)?\s*([\s\S]*)$"


@dataclass(frozen=True)
class Criterion:
    op: str
    rhs: str

    @property
    def number(self) -> float | None:
        return float(self.rhs) if re.match(NUMBER, self.rhs) else None


def split(raw: str | float | None) -> Criterion:
    """The operator (= if none) and the right side of a criterion; null is the empty text."""
    text = "" if raw is None else f"{raw:.15g}" if isinstance(raw, float) else str(raw)
    op, rhs = re.match(PATTERN, text).groups()
    return Criterion(op or "=", rhs)


def split_column(raw: Column) -> Column:
    """The same for a column: struct(op, rhs)."""
    text = F.coalesce(raw, F.lit(""))
    op = F.regexp_extract(text, PATTERN, 1)
    return F.struct(F.when(op == "", "=").otherwise(op).alias("op"), F.regexp_extract(text, PATTERN, 2).alias("rhs"))


def value_of(kind: str, v: Column) -> Column:
    """struct(text, err): what the right side of a criterion is when it comes from a cell.

    year: a blank or an error is an error, never another year; numbers are spelled
    without a point if whole, texts lose blanks around them. cell: a blank is the
    blank criterion (null). expr: a blank or an error is an error; escapes are undone.
    """
    blank = v["num"].isNull() & v["txt"].isNull()
    if kind == "year":
        text, err = F.coalesce(general_number(v["num"]), F.trim(v["txt"])), blank
    elif kind == "cell":
        text, err = F.coalesce(general_number(v["num"]), v["txt"]), F.lit(False)
    elif kind == "expr":
        text, err = unescape(F.coalesce(v["txt"], general_number(v["num"]))), blank
    else:
        raise ValueError(f"unknown kind of criterion: {kind}")
    return F.struct(text.alias("text"), F.when(err, F.lit(f"unresolved {kind}")).alias("err"))


def relation(op: str, a: Column, b: Column) -> Column:
    return {"=": a == b, "<>": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def on_long_text(col: Column, c: Criterion) -> Column:
    """A text column of a long table."""
    if c.op == "<>" and c.rhs == "":
        return F.coalesce(col != "", F.lit(False))
    if c.op in ("=", "<>") or c.number is None:
        return F.coalesce(relation(c.op, ascii_fold(col), ascii_fold(F.lit(c.rhs))), F.lit(False))
    return F.coalesce(relation(c.op, number_prefix(col), F.lit(c.number)), F.lit(False))


def on_long_number(col: Column, c: Criterion) -> Column:
    """A number column of a long table: numbers come before all texts."""
    if c.number is None:
        return col.isNotNull() & F.lit(c.op in ("<>", "<", "<="))
    return F.coalesce(relation(c.op, col, F.lit(c.number)), F.lit(False))


def on_grid(num: Column, txt: Column, c: Criterion) -> Column:
    """A cell of a sparse grid; both null is a blank cell."""
    there = num.isNotNull() | txt.isNotNull()
    if c.rhs == "" and c.op in ("=", "<>"):
        return there if c.op == "<>" else ~there
    same = F.coalesce(ascii_fold(txt) == ascii_fold(F.lit(c.rhs)), F.lit(False))
    if c.number is not None:
        same = same | F.coalesce(num == c.number, F.lit(False))
    if c.op in ("=", "<>"):
        return same if c.op == "=" else ~same
    if c.number is not None:
        return F.coalesce(relation(c.op, num, F.lit(c.number)), F.lit(False))
    return F.coalesce(relation(c.op, ascii_fold(txt), ascii_fold(F.lit(c.rhs))), F.lit(False))


def on_page(num: Column, txt: Column, c: Criterion) -> Column:
    """A cell of a page: as on_grid, with numbers at 15 digits, numeric texts as numbers, and full case folding."""
    blank = num.isNull() & (txt.isNull() | (txt == ""))
    if c.rhs == "" and c.op in ("=", "<>"):
        return ~blank if c.op == "<>" else blank
    value = fifteen_digits(F.coalesce(num, text_number(txt)))
    upper = F.upper(F.trim(txt))
    if c.number is not None:
        hit = F.coalesce(relation("=" if c.op == "<>" else c.op, value, fifteen_digits(F.lit(c.number))), F.lit(False)) & ~blank
    else:
        hit = F.coalesce(relation("=" if c.op == "<>" else c.op, upper, F.upper(F.lit(c.rhs.strip()))), F.lit(False))
    return ~hit if c.op == "<>" else hit
