"""Years from one base year, and changes from year to year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import divide

BREAK = 2020


def years(spark: SparkSession, anchor: int, n: int) -> DataFrame:
    """pos, year: n years that end with the anchor; move it, and all years move."""
    return spark.range(n).select((F.col("id") + 1).cast("int").alias("pos"), (F.lit(anchor - n + 1) + F.col("id")).cast("int").alias("year"))


def years_before(anchors: DataFrame, anchor: str, n: int) -> DataFrame:
    """anchor, pos, year for every anchor of a table: the n years that end with it."""
    step = F.array(*(F.struct(F.lit(i + 1).alias("pos"), (F.col(anchor) - (n - 1 - i)).cast("int").alias("year")) for i in range(n)))
    return anchors.select(anchor, F.inline(step))


def growth(df: DataFrame, value: str, year: str, series: list[str], break_year: int = BREAK, out: str = "growth") -> DataFrame:
    """Percent change to the row before; text marks: "…" across the break in the series, "-" from 0 or from nothing."""
    w = W.partitionBy(*series).orderBy(year)
    before, before_year = F.lag(value).over(w), F.lag(year).over(w)
    change = divide(F.col(value) - before, before / 100.0)
    crossed = (before_year < break_year) & (F.col(year) >= break_year)
    return df.withColumns({out: F.when(~F.coalesce(crossed, F.lit(False)), change), f"{out}_mark": F.when(crossed, "…").when(change.isNull(), "-")})


def share(value: Column, series: list[str]) -> Column:
    """Percent of the series' total."""
    return divide(value, F.sum(value).over(W.partitionBy(*series)) / 100.0)
