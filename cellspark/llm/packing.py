"""Best-fit packing: cut documents into pieces of at most `capacity` tokens and pack them in as few sequences.

Pieces come from one pass over the texts. Those that fill a sequence are done.
The others are packed in bulk-synchronous rounds over two tables, documents
without a place and gaps: both are range-sorted by size into one line, a
distributed sweep finds each document the smallest gap that holds it and is
still free, lower ranks first, and the gaps shrink for the next round. A gap
that holds the longest document several times takes as many documents in a
round. Only totals come to the driver; no task sees more than a partition of
the line, or one row per partition.

* null or empty text: one piece of the end token alone. Very long texts: cut
  into pieces of `capacity`, the first takes the remainder.
* Repeated rows and ties: packed one by one, ranked by the order of their rows.
* Null doc_id: packed like any other. An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import flat, read, scratch_path, slices, table
from .encoding import pieces, tokenizer_path

CAPACITY, END = 1024, 2


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids and the end token."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pieces(path, True)
        for b in slices(batches, "text"):
            data, offsets = flat(b.column(1))
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(tokens.rows(data, offsets)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                at, k = 0, 0
                while at < len(ids):
                    to = at + ((len(ids) - 1) % capacity + 1 if k == 0 else capacity)
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[at:to].tobytes()))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def slots(gaps: DataFrame, longest: int, most: int) -> DataFrame:
    """size, doc (false), id (the sequence), k, free: up to `most` places in each gap, all but the last as long as the longest document."""
    n = F.least(F.greatest(F.floor(F.col("free") / longest), F.lit(1)), F.lit(most))
    each = gaps.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)))
    size = F.when(F.col("k") < F.col("n") - 1, F.lit(longest)).otherwise(F.col("free") - (F.col("n") - 1) * longest)
    return each.select(size.cast("long").alias("size"), F.lit(False).alias("doc"), F.col("sequence_id").alias("id"), "k", "free")


def sweep(line: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Successors by one sweep over a line(size, doc, id, k, free) of documents and slots.

    From the largest size down, slots before documents of their size, a document
    takes the slot that was met last and is still free: the smallest that holds
    it. That is how brackets match: partitions of the sorted line sum up how many
    slots are open (a table of one row per partition carries the sums across), and
    slot and document of one depth that follow each other belong together.
    Conflicts need no retry: of documents that want the same slots, those of
    lower rank take them, and where slots run out, the higher ranks go without.

    Returns (id, length, sequence_id, k, free) of the documents with a slot, and
    (id, length) of those without.
    """
    order = [F.desc("size"), "doc", "id", "k"]
    laid = table(line.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "packing-line")
    own = W.partitionBy("part").orderBy(*order)
    step = F.when(F.col("doc"), -1).otherwise(1)
    runs = laid.withColumn("depth", F.sum(step).over(own.rowsBetween(W.unboundedPreceding, 0)))
    runs = table(runs.withColumn("low", F.min("depth").over(own.rowsBetween(W.unboundedPreceding, -1))), "packing-runs")
    # One row per partition: their number bounds these windows.
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = runs.groupBy("part").agg(F.sum(step).alias("total"), F.min("depth").alias("lowest"))
    totals = totals.withColumn("open", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    totals = totals.select("part", "open", F.least(F.coalesce(F.min(F.col("open") + F.col("lowest")).over(earlier), F.lit(0)), F.lit(0)).alias("floor"))
    # The floor is as many documents as found no slot so far; above it, slots are open.
    floor = F.least("floor", F.col("open") + F.col("low"))
    depth = F.col("open") + F.col("depth")
    marked = runs.join(F.broadcast(totals), "part").select("size", "doc", "id", "k", "free", "part", (depth - floor + F.when(F.col("doc"), 1).otherwise(0)).alias("level"))
    without = marked.filter(F.col("doc") & (F.col("level") < 1)).select("id", F.col("size").alias("length"))

    def met(rows: DataFrame, *by: str) -> DataFrame:
        w = W.partitionBy(*by).orderBy(*order)
        slot = F.when(~F.col("doc"), F.struct(F.col("id").alias("sequence_id"), "k", "free"))
        return rows.withColumns({"slot": F.lag(slot).over(w), "taken": F.coalesce(F.lead("doc").over(w), F.lit(False))})

    inside = table(met(marked.filter("level > 0"), "part", "level"), "packing-met")
    # A partition leaves a slot and a document of a depth at most; they meet those of others.
    across = met(inside.filter("if(doc, slot is null, not taken)").drop("slot", "taken"), "level")
    got = inside.unionByName(across).filter("doc and slot is not null")
    return got.select("id", F.col("size").alias("length"), "slot.*"), without


def best_fit(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """id, sequence_id, offset of all docs(id, length), and the number of sequences; no document is longer than capacity.

    Rounds: gaps offer slots, a sweep gives each document the smallest slot that
    holds it, gaps shrink by what they took. When no gap holds the shortest
    document any more, as many sequences are opened as what is left needs at
    least: its tokens by capacity, or one for each document above half of it.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-placed")
    paths: list[str] = []
    gaps, opened = None, 0
    sizes = [F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"), F.min("length").alias("shortest"), F.max("length").alias("longest"), F.count_if(F.col("length") * 2 > capacity).alias("large")]
    left = docs.agg(*sizes).first()
    while left["n"]:
        fitting = gaps.filter(F.col("free") >= left["shortest"]).count() if gaps else 0
        if not fitting:
            fitting = max(-(-left["total"] // capacity), left["large"])
            gaps = spark.range(opened, opened + fitting).select(F.col("id").alias("sequence_id"), F.lit(capacity).cast("long").alias("free"))
            opened += fitting
        gaps = gaps.filter(F.col("free") >= left["shortest"])
        # No more slots than documents and gaps need together.
        offered = slots(gaps, left["longest"], 1 + -(-left["n"] // fitting))
        line = docs.select(F.col("length").cast("long").alias("size"), F.lit(True).alias("doc"), "id", F.lit(0).alias("k"), F.lit(None).cast("long").alias("free")).unionByName(offered)
        got, docs = sweep(line)
        before = F.sum("length").over(W.partitionBy("sequence_id").orderBy("k").rowsBetween(W.unboundedPreceding, -1))
        paths.append(f"{path}/{len(paths)}")
        placed = table(got.select("id", "length", "sequence_id", (F.lit(capacity) - F.col("free") + F.coalesce(before, F.lit(0))).alias("offset")), "packing-placed", paths[-1])
        taken = placed.groupBy("sequence_id").agg(F.sum("length").alias("taken"))
        gaps = table(gaps.join(taken, "sequence_id", "left").select("sequence_id", (F.col("free") - F.coalesce("taken", F.lit(0))).alias("free")), "packing-gaps")
        left = docs.agg(*sizes).first()
    schema = "id long, length long, sequence_id long, offset long"
    placed = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return placed.select("id", "sequence_id", "offset"), opened


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of cuts with sequence_id and offset; cuts must be a table (read twice, same rows)."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    laid = table(cuts.filter(F.col("length") < capacity).select(*columns, F.monotonically_increasing_id().alias("id")), "packing")
    placed, opened = best_fit(laid.select("id", "length"), capacity)
    packed = laid.join(placed, "id").select(*columns, "sequence_id", "offset")
    full = cuts.filter(F.col("length") >= capacity).select(*columns, (F.lit(opened) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(cut(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")), "pieces"))
