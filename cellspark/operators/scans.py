"""Running sums and ranks along lines of any length: no task ever holds a whole line.

Rows are dealt out by ranges of (keys, order), so that a line lies in
neighbouring partitions. Each partition sums up its own stretch of every line; what
lies before a stretch is the sum of the stretches before it, which only lines over
several partitions need: no more than two rows per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written


def running(df: DataFrame, keys: list[str], order: list[tuple[Column, bool]], sums: dict[str, Column], parts: int | None = None, take: str = "sum") -> DataFrame:
    """df with running sums (take: or minima "min", maxima "max") along each line of equal keys, the row itself included.

    order: columns, and whether they descend (nulls last, else first). Rows that share
    it all come in some order, the same for all sums. sums: name -> what is added up;
    nulls add nothing, and a sum over nulls alone is null. Keys may be null;
    without keys all rows are one line. parts: number of ranges, else as the session has it.
    """
    fold = {"sum": F.sum, "min": F.min, "max": F.max}[take]
    names, line = df.columns, ["scan_line", *keys]
    o, v = [f"scan_o{i}" for i in range(len(order))], [f"scan_v{i}" for i in range(len(sums))]
    # In a written table the constant is a column like any other, so that the line of all rows has a key, too.
    laid = df.withColumns({"scan_line": F.lit(0), **{n: c for n, (c, _) in zip(o, order, strict=True)}, **{n: c for n, c in zip(v, sums.values(), strict=True)}})
    by = [F.col(n).desc() if down else F.col(n).asc() for n, (_, down) in zip(o, order, strict=True)]
    spread = [*line, *by, F.xxhash64(*names)]  # many rows that share their place need not share a partition
    laid = laid.repartitionByRange(parts, *spread) if parts else laid.repartitionByRange(*spread)
    laid = written(laid.withColumns({"scan_part": F.spark_partition_id(), "scan_row": F.monotonically_increasing_id()}), "line")
    stretches = laid.groupBy("scan_part", *line).agg(*(fold(n).alias(n) for n in v))
    before = W.partitionBy(*line).orderBy("scan_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = stretches.select(F.col("scan_part").alias("scan_p"), *(F.col(k).alias(f"scan_k{i}") for i, k in enumerate(line)), *(fold(n).over(before).alias(f"before_{n}") for n in v))
    offsets = offsets.filter(reduce(Column.__or__, [F.col(f"before_{n}").isNotNull() for n in v]))
    own = W.partitionBy("scan_part", *line).orderBy(*by, "scan_row").rowsBetween(W.unboundedPreceding, 0)
    local = laid.select(*names, "scan_part", "scan_line", *(fold(n).over(own).alias(n) for n in v))
    on = reduce(Column.__and__, [F.col("scan_part") == F.col("scan_p"), *(F.col(k).eqNullSafe(F.col(f"scan_k{i}")) for i, k in enumerate(line))])
    both = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}[take]  # the latter two leave nulls out
    total = lambda n: both(F.col(n), F.col(f"before_{n}"))
    # A line with something before this partition is the first one here, or all of it: a row per partition.
    return local.join(F.broadcast(offsets), on, "left").select(*names, *(total(n).alias(name) for n, name in zip(v, sums, strict=True)))


def ranked(df: DataFrame, value: str, within: list[str], out: str = "rank", parts: int | None = None) -> DataFrame:
    """RANK() in descending order along lines of any length: 1 for the largest, equal values share a rank, null values have none.

    Ranks are those of distinct values, each counted before the line is laid.
    """
    keys = [f"_w{i}" for i in range(len(within))]
    each = df.filter(F.col(value).isNotNull()).groupBy(*(F.col(k).alias(n) for k, n in zip(within, keys, strict=True)), F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    line = running(each, keys, [(F.col("_value"), True)], {"_upto": F.col("_n")}, parts)
    ranks = line.select(*keys, "_value", (F.col("_upto") - F.col("_n") + 1).alias("_rank"))
    on = reduce(Column.__and__, [F.col(value) == F.col("_value"), *(F.col(k).eqNullSafe(F.col(n)) for k, n in zip(within, keys, strict=True))])
    return df.join(ranks, on, "left").select(*df.columns, F.col("_rank").alias(out))


def successors(asked: DataFrame, places: DataFrame, keys: list[str], first: str, at: str, out: str, parts: int | None = None) -> DataFrame:
    """asked with the smallest place of its line that isn't before `first`, or null: places(keys, at), asked(keys, first, ...).

    Along each line in falling order, the last place seen is the one that a question wants, however
    often a key repeats. No row of one side meets rows of the other.
    """
    row = F.struct(*asked.columns)
    none = F.lit(None).cast(asked.select(row).schema[0].dataType)
    line = asked.select(*keys, F.col(first).alias("here"), F.lit(None).cast(dict(places.dtypes)[at]).alias("place"), row.alias("ask"))
    line = line.unionByName(places.select(*keys, F.col(at).alias("here"), F.col(at).alias("place"), none.alias("ask")).distinct())
    got = running(line, keys, [(F.col("here"), True), (F.col("ask").isNotNull(), False)], {out: F.col("place")}, parts, "min")
    return got.filter("ask is not null").select("ask.*", out)
