"""Conditional aggregates in bulk: a table of criteria rows against a table of facts in one job.

Rows of criteria that ask the same are computed once. A criteria table up to
MOST_BROADCAST rows (counted first) is sent to the executors, so that the facts
aren't shuffled before they are summed up; a larger one is joined by shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.criteria import Criterion, on_grid, relation
from ..functions.scalars import ascii_fold
from .scans import running

MOST_BROADCAST = 100_000


def few(df: DataFrame) -> bool:
    """Whether df has no more than MOST_BROADCAST rows; counts no further than that."""
    return df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it is small."""
    return F.broadcast(df) if few(df) else df


def conditional(facts: DataFrame, criteria: DataFrame, equal: dict[str, str], aggregate: Column, compare: dict[str, tuple[str, str]] | None = None, empty: float | int | None = 0, qid: str = "qid") -> DataFrame:
    """qid, value for each row of criteria.

    equal: fact column -> criteria column, matched without regard to ASCII case
    (numbers as they are), one at least; compare: fact column -> (operator, criteria column).
    empty: the value where no fact matches. A null criterion matches the empty text only.
    Questions with bounds alone are bounded() or bulk.compared(): they need sums, counts or means.
    """
    if not equal:
        raise ValueError("every question would meet every fact: use bounded or bulk.compared")
    compare = compare or {}
    kinds = dict(facts.dtypes)
    fold = lambda c, k: ascii_fold(F.coalesce(c, F.lit(""))) if kinds[k] == "string" else c
    keys = [fold(F.col(c), f).alias(f"k{i}") for i, (f, c) in enumerate(equal.items())] + [F.col(c).alias(f"x{i}") for i, (_, c) in enumerate(compare.values())]
    names = [f"k{i}" for i in range(len(equal))] + [f"x{i}" for i in range(len(compare))]
    asked = criteria.select(qid, *keys)
    once = asked.groupBy(*names).agg(F.min(qid).alias("rep"))
    on = [(ascii_fold(F.col(f)) if kinds[f] == "string" else F.col(f)) == F.col(f"k{i}") for i, f in enumerate(equal)]
    on += [relation(op, F.col(f), F.col(f"x{i}")) for i, (f, (op, _)) in enumerate(compare.items())]
    send = F.broadcast if few(once) else lambda df: df
    hits = facts.join(send(once), reduce(Column.__and__, on), "inner")
    got = hits.groupBy("rep").agg(aggregate.alias("value"))  # no more rows than questions
    by_question = send(once.join(send(got), "rep", "left"))
    out = asked.join(by_question, reduce(Column.__and__, [asked[n].eqNullSafe(by_question[n]) for n in names]), "left")
    value = F.col("value") if empty is None else F.coalesce(F.col("value"), F.lit(empty))
    return out.select(asked[qid], value.alias("value"))


def bounded(facts: DataFrame, criteria: DataFrame, equal: dict[str, str], bound: tuple[str, str, str], value: Column, empty: float | int | None = 0, qid: str = "qid") -> DataFrame:
    """qid, value for each row of criteria: sums of value over the facts that meet equal columns and one bound.

    equal: as in conditional(); bound: (fact column, >=, >, <= or <, criteria column).
    Facts are summed up by equal columns and bounded column where they are scanned.
    These sums and the questions then form one line per combination of equal columns,
    along which a running sum answers all questions: no fact meets more than one row,
    and no task holds a whole line.
    """
    kinds = dict(facts.dtypes)
    fold = lambda c, k: ascii_fold(c) if kinds[k] == "string" else c
    blank = lambda c, k: F.coalesce(c, F.lit("")) if kinds[k] == "string" else c
    column, op, limit = bound
    names = [f"k{i}" for i in range(len(equal))]
    summed = facts.select(*(fold(F.col(f), f).alias(n) for n, f in zip(names, equal, strict=True)), F.col(column).cast("double").alias("x"), value.alias("v"))
    # What meets no bound at all: nulls.
    summed = summed.filter(F.col("x").isNotNull()).groupBy(*names, "x").agg(F.sum("v").alias("v"))
    asked = criteria.select(qid, *(fold(blank(F.col(c), f), f).alias(n) for n, (f, c) in zip(names, equal.items(), strict=True)), F.col(limit).cast("double").alias("x"))
    none = F.lit(None).cast(summed.schema["v"].dataType)
    line = summed.select(*names, "x", "v", F.lit(None).cast(asked.schema[qid].dataType).alias(qid), F.lit(False).alias("question"))
    line = line.unionByName(asked.select(*names, "x", none.alias("v"), qid, F.lit(True).alias("question")))
    # Facts at the bound itself come before the question if they count.
    order = [(F.col("x"), op in (">=", ">")), (F.col("question") if op in (">=", "<=") else ~F.col("question"), False)]
    got = running(line, names, order, {"total": F.col("v")}).filter("question")
    value = F.when(F.col("x").isNotNull(), F.col("total"))
    return got.select(qid, (value if empty is None else F.coalesce(value, F.lit(empty))).alias("value"))


def one_pass(facts: DataFrame, questions: dict[str, Column]) -> DataFrame:
    """A row with one column per question (an aggregate with its own condition): one scan, no join."""
    return facts.agg(*(q.alias(name) for name, q in questions.items()))


def pivot_grid(grid: DataFrame, columns: list[int]) -> DataFrame:
    """One row per (src, sheet, r) with n<c>, t<c> for each wanted column number: no self-joins later."""
    aggs = []
    for c in columns:
        here = F.col("c") == c
        aggs += [F.max(F.when(here, F.col("v_num"))).alias(f"n{c}"), F.max(F.when(here, F.col("v_txt"))).alias(f"t{c}")]
    return grid.filter(F.col("c").isin(columns)).groupBy("src", "sheet", "r").agg(*aggs)


def grid_conditional(grid: DataFrame, src: str, sheet: str, value: int | None, criteria: dict[int, Criterion]) -> DataFrame:
    """total and matches over a grid's rows: the sum of column `value` (or none) and the number of rows that meet all criteria.

    Rows are those in which the value column, or the first column with a
    positive criterion, has a cell; one of them must be given.
    """
    positive = [c for c, k in criteria.items() if not (k.op == "<>" or (k.op == "=" and k.rhs == ""))]
    base = value if value is not None else positive[0] if positive else None
    if base is None:
        raise ValueError("a count needs a criterion that a blank cell does not meet")
    wide = pivot_grid(grid.filter((F.col("src") == src) & (F.col("sheet") == sheet)), sorted({*criteria, base}))
    hits = wide.filter(F.col(f"n{base}").isNotNull() | F.col(f"t{base}").isNotNull())
    for c, k in criteria.items():
        hits = hits.filter(on_grid(F.col(f"n{c}"), F.col(f"t{c}"), k))
    return hits.agg(F.coalesce(F.sum(f"n{base}"), F.lit(0.0)).alias("total"), F.count("*").alias("matches"))
