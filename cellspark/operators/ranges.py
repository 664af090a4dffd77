"""Aggregates over ranges of cells: every function on all ranges at once, one row per range.

Sheets are covered by tiles of RADIX**i rows and RADIX**j columns. A range is a
disjoint union of tiles, few of each size; a cell lies in one tile of each size,
and tiles are added up from smaller ones. So ranges meet sums, counts and maxima of tiles by an equi join, and
rows grow with ranges and cells, not with their product.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .aggregates import small

#: Rows and columns of a tile per side of the next smaller one, and the sizes of sides: RADIX**0 to RADIX**(SIZES - 1).
RADIX, SIZES = 4, 12
BITS = RADIX.bit_length() - 1


def in_range(ranges: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells inside the ranges(qid, part, sheet, r1, c1, r2, c2), with qid and pos (from 1, row by row): a row for each cell of each range."""
    hit = (ranges["part"] == cells["part"]) & (ranges["sheet"] == cells["sheet"]) & cells["r"].between(ranges["r1"], ranges["r2"]) & cells["c"].between(ranges["c1"], ranges["c2"])
    pos = (cells["r"] - ranges["r1"]) * (ranges["c2"] - ranges["c1"] + 1) + cells["c"] - ranges["c1"] + 1
    return cells.join(ranges, hit).select(ranges["qid"], pos.alias("pos"), cells["num"], cells["txt"])


def arguments(ranges: DataFrame, cells: DataFrame, single: DataFrame) -> DataFrame:
    """qid, num, txt: the values of arguments that are ranges, and those of single(qid, num, txt) that are values themselves."""
    return in_range(ranges, cells).select("qid", "num", "txt").union(single.select("qid", "num", "txt"))


def sides(lo: Column, hi: Column, name: str) -> Column:
    """array<struct<size, first, end>>: the numbers from lo to hi as stretches of RADIX**size aligned numbers, those numbered from first to before end.

    Of each size those are taken that lie in [lo, hi] while the next larger one around
    them doesn't: below the first and behind the last whole larger one. Some are empty.
    """
    lo, hi = lo.cast("long"), hi.cast("long") + 1  # half open from here on
    up = lambda x, i: F.shiftright(x + ((1 << BITS * i) - 1), BITS * i)
    out = []
    for i in range(SIZES):
        first, end = up(lo, i), F.shiftright(hi, BITS * i)
        if i == SIZES - 1:
            parts = [(first, end)]
        else:
            # The next size covers what lies between; where it covers nothing, all of this size are taken at once.
            a, z = F.shiftleft(up(lo, i + 1), BITS), F.shiftleft(F.shiftright(hi, BITS * (i + 1)), BITS)
            parts = [(first, F.least(end, F.when(a < z, a).otherwise(end))), (F.when(a < z, z).otherwise(end), end)]
        out += [F.struct(F.lit(i).alias(f"{name}_size"), a.alias("_first"), z.alias("_end")) for a, z in parts]
    return F.array(*out)


def tiles(ranges: DataFrame) -> DataFrame:
    """qid, part, sheet and the tiles (r_size, r_place, c_size, c_place) of ranges(qid, part, sheet, r1, c1, r2, c2); empty ranges have none."""
    places = F.explode(F.sequence(F.col("_first"), F.col("_end") - 1))
    names = ["qid", "part", "sheet"]
    by_columns = ranges.select(*names, "r1", "r2", F.inline(sides(F.col("c1"), F.col("c2"), "c"))).filter("_first < _end").select(*names, "r1", "r2", "c_size", places.alias("c_place"))
    by_rows = by_columns.select(*names, "c_size", "c_place", F.inline(sides(F.col("r1"), F.col("r2"), "r"))).filter("_first < _end")
    return by_rows.select(*names, "r_size", places.alias("r_place"), "c_size", "c_place")


def range_aggregates(ranges: DataFrame, cells: DataFrame, single: DataFrame | None = None) -> DataFrame:
    """qid, total, largest, filled: SUM, MAX (0 without numbers) and COUNTA; texts, blanks and errors don't add up.

    Several ranges of one qid are its arguments: a cell in two of them counts twice.
    single(qid, num, txt): further arguments of the same questions that are no ranges.
    """
    at = ["part", "sheet", "r_size", "r_place", "c_size", "c_place"]
    asked = written(tiles(ranges.repartition(ranges.sparkSession.sparkContext.defaultParallelism)), "tiles")
    top, across = asked.agg(F.max("r_size"), F.collect_set("c_size")).first()  # SIZES numbers at most
    filled = F.col("num").isNotNull() | F.coalesce(F.col("txt") != "", F.lit(False))
    # The rows and columns that some range can reach.
    reach = ranges.filter("r1 <= r2 and c1 <= c2").groupBy("part", "sheet").agg(*(f(c).alias(f"_{c}") for c, f in (("r1", F.min), ("r2", F.max), ("c1", F.min), ("c2", F.max))))
    inside = cells.filter(filled).join(small(reach), ["part", "sheet"]).filter("r between _r1 and _r2 and c between _c1 and _c2")
    step = F.array(*(F.struct(F.lit(j).alias("c_size"), F.shiftright(F.col("c").cast("long"), BITS * j).alias("c_place")) for j in sorted(across))) if across else F.array().cast("array<struct<c_size:int,c_place:bigint>>")
    each = inside.select("part", "sheet", F.col("r").cast("long").alias("r_place"), F.inline(step), F.col("num").alias("total"), F.col("num").alias("largest"), F.lit(1).cast("long").alias("filled"))
    # Tiles of each height are added up from those of the height before, a RADIX-th as many.
    heights = []
    for i in range((top or 0) + 1):
        by = ["part", "sheet", "c_size", "c_place"]
        each = each.groupBy(*by, (F.shiftright("r_place", BITS) if i else F.col("r_place")).alias("r_place")).agg(F.sum("total").alias("total"), F.max("largest").alias("largest"), F.sum("filled").alias("filled"))
        each = written(each, "heights")
        heights.append(each.withColumn("r_size", F.lit(i)))
    sums = reduce(DataFrame.unionByName, heights)
    met = asked.join(sums, at).select("qid", "total", "largest", "filled")
    if single is not None:
        met = met.unionByName(single.filter(filled).select("qid", F.col("num").alias("total"), F.col("num").alias("largest"), F.lit(1).cast("long").alias("filled")))
    got = met.groupBy("qid").agg(F.sum("total").alias("total"), F.max("largest").alias("largest"), F.sum("filled").alias("filled"))
    qids = reduce(DataFrame.union, [ranges.select("qid"), *([] if single is None else [single.select("qid")])]).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return qids.join(got, "qid", "left").select("qid", zero("total"), zero("largest"), F.coalesce("filled", F.lit(0)).alias("filled"))


def count_where(df: DataFrame, *conditions: Column, by: list[str] = ()) -> DataFrame:
    """n: rows that meet all conditions (aligned ranges are columns of one row each)."""
    hit = F.lit(True)
    for c in conditions:
        hit = hit & F.coalesce(c, F.lit(False))
    return df.groupBy(*by).agg(F.count_if(hit).alias("n"))
