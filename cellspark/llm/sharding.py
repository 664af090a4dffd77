"""Sharding: contiguous shards of near equal byte size from global prefix sums.

DataFrame functions only. Documents are range-partitioned by doc_id; each
partition's total size gives the offset of the next one, so that a document's
global prefix sum needs no task that sees all rows. Shard k takes the documents
that begin within the k-th of n equal parts of all bytes.

* null doc_id: sorts first. Repeated rows and ties in doc_id: told apart by
  checksum, size and a row number that is written down once, so that all
  columns of a result agree.
* Equal texts are ties in nothing but their size: they lie in doc_id order like all
  others and may be cut apart between two shards, since a group may be larger than a shard.
* null or empty text: size is the overhead alone. An empty table: no rows.
* Extra columns are ignored; the result holds the columns named below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read, table

SHARDS, OVERHEAD = 24, 8


def shards(docs: DataFrame, n: int = SHARDS, overhead: int = OVERHEAD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, size, text_crc32, shard (0 to n-1, contiguous in key order), slot (gapless in its shard), start (bytes before it)."""
    if n < 1 or overhead < 1:
        raise ValueError("there must be a shard, and each row must have a size")
    spark = docs.sparkSession
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    slim = docs.select(F.col(key).alias("k"), (F.octet_length(raw) + F.lit(overhead)).cast("long").alias("size"), F.crc32(raw).alias("crc"), F.monotonically_increasing_id().alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The row number and the partition number must not change once they are used: a table keeps them.
    laid = table(slim.repartitionByRange(parts, "k", "crc", "size", "tie").withColumn("part", F.spark_partition_id()), "shards")
    order = [F.col(c).asc_nulls_first() for c in ("k", "crc", "size", "tie")]
    # One row per partition: its number bounds this window.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = laid.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(W.partitionBy()).alias("all_bytes"),
    )
    own = W.partitionBy("part").orderBy(*order)
    placed = laid.join(F.broadcast(totals), "part").select(
        "k",
        "size",
        "crc",
        "all_bytes",
        (F.col("bytes_before") + F.sum("size").over(own.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(own) - 1).alias("row"),
    )
    placed = table(placed.withColumn("shard", F.least(F.floor(F.col("start").cast("decimal(38,0)") * n / F.col("all_bytes")).cast("int"), F.lit(n - 1))), "shards-placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # n rows at most
    return placed.join(F.broadcast(firsts), "shard").select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"), "start")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
