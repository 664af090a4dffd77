"""Observations that arrive as files: running conditional sums by Structured Streaming, with the batch functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def running_totals(observations: DataFrame, keys: list[str], value: str, time: str | None = None, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Totals and counts per key, or per key and time window.

    A window closes when the newest row is `late` beyond its end: refresh() with
    windows=True writes it then, once; rows that come later are left out, and its state goes.
    """
    by = list(keys)
    if time:
        observations = observations.withWatermark(time, late)
        by.append(F.window(time, window).alias("window"))
    return observations.groupBy(*by).agg(F.sum(value).alias("total"), F.count("*").alias("rows"))


def refresh(totals: DataFrame, target: str, checkpoint: str, windows: bool = False) -> StreamingQuery:
    """Process what has arrived and stop.

    Without windows each batch writes all totals as target/version=<batch>, the last of
    which counts. With windows each batch writes those that have closed, so that all
    versions together are the table. A batch that is repeated after a failure replaces its own version.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/version={number}")

    mode = "append" if windows else "complete"
    return totals.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
