"""Ranks, running counts and sorted tables by window functions.

`within` are the columns that name a range; a range without any is one task,
so give one wherever there is more than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_descending(df: DataFrame, value: str, within: list[str], out: str = "rank") -> DataFrame:
    """RANK(): 1 for the largest; equal values share a rank; null values have none."""
    w = W.partitionBy(*within, F.col(value).isNotNull()).orderBy(F.desc(value))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.rank().over(w)))


def running_count(df: DataFrame, value: str, order: str, within: list[str], out: str = "nth") -> DataFrame:
    """COUNTIF over the range from its first row to this one: the how-manieth of its value a row is."""
    w = W.partitionBy(*within, value).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.count(value).over(w))


def sort_position(df: DataFrame, value: str, order: str, within: list[str], out: str = "pos") -> DataFrame:
    """RANK() + COUNTIF() - 1: each row's place in descending order, ties by `order`."""
    w = W.partitionBy(*within, F.col(value).isNotNull()).orderBy(F.desc(value), order)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.row_number().over(w)))


def rank_where(df: DataFrame, value: str, condition: Column, within: list[str], out: str = "rank") -> DataFrame:
    """Rank among the rows that meet a condition: 1 + how many of them are larger."""
    hit = F.coalesce(condition, F.lit(False))
    w = W.partitionBy(*within).orderBy(F.desc(value)).rangeBetween(W.unboundedPreceding, W.currentRow)
    peers = W.partitionBy(*within, value)
    larger = F.sum(hit.cast("long")).over(w) - F.sum(hit.cast("long")).over(peers)
    return df.withColumn(out, F.when(hit, larger + 1))
