"""Substring dedup: drop every word covered by a window of words that an earlier document has, too.

Each document's windows of `size` words get Rabin-Karp hashes. A task packs
the windows of a slice of texts into arrays by hash bucket, so that the exchange
carries few rows; Spark unpacks them behind it and finds each hash's
smallest doc_id with a window function. Before that exchange a slice settles
what it can: where several of its documents share a window, only the smallest
doc_id stands for it outside, and a task remembers such windows for its next
slices, so that a passage in a third of all documents arrives about once per
task, not once per document. Repeated windows then meet their document again (a
list no longer than its text), where neighbouring ones merge into maximal
removal intervals.

Windows are compared by 96 bits, of two hashes over word hashes.

* null or empty text, texts shorter than a window: nothing is removed; null
  stays null. Very long texts: all windows count.
* Ties and repeated rows: a window that only documents with the same doc_id
  share stays. Null doc_id: the row is kept whole and is nobody's predecessor.
* doc_id is a whole number. An empty table: no rows. Input columns that bear a result's name give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, even_keys, flat, mix, read, slices, table, windows

SIZE = 13
#: Bytes of text whose windows are packed together.
SLICE = 2_000_000
#: Shared windows that a task remembers.
MOST_SHARED = 200_000
#: Makes the second hash another function of a window's words.
OTHER = np.uint64(0xA24BAED4963EE407)
RESULTS = ("n_words", "n_removed", "spans")


def packed(keys: np.ndarray, d: np.ndarray, h: np.ndarray, c: np.ndarray) -> list[pa.Array]:
    """Rows (key, docs, which, hs, cs): hashes of a key with, for each, which of the row's at most 128 documents it is of."""
    order = np.lexsort((d, keys))
    keys, d, h, c = keys[order], d[order], h[order], c[order]
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
    new_doc = new_key.copy()
    new_doc[1:] |= d[1:] != d[:-1]
    nth = np.cumsum(new_doc) - 1  # documents so far, counted anew for each key
    in_key = nth - np.repeat(nth[new_key], np.diff(np.append(np.flatnonzero(new_key), len(keys))))
    new_row = new_key | (new_doc & (in_key % 128 == 0))
    rows, docs = np.append(np.flatnonzero(new_row), len(keys)), np.flatnonzero(new_doc)
    doc_rows = np.searchsorted(docs, rows)
    lists = lambda cuts, x: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x))
    return [pa.array(keys[rows[:-1]]), lists(doc_rows, d[docs]), lists(rows, (in_key % 128).astype(np.int8)), lists(rows, h.view(np.int64)), lists(rows, c)]


class Shared:
    """Windows that several documents of a task's slices have, with the smallest doc_id sent out for each; at most `most`."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.h, self.c, self.d = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def later(self, h: np.ndarray, c: np.ndarray, d: np.ndarray, several: np.ndarray) -> np.ndarray:
        """Which of a slice's windows (distinct, ascending h; d: the smallest doc_id; several: in more than one document) an earlier slice's document with a smaller id has."""
        at = np.minimum(np.searchsorted(self.h, h), max(len(self.h) - 1, 0))
        known = (self.h[at] == h) & (self.c[at] == c) if len(self.h) else np.zeros(len(h), bool)
        at = at[known]
        out = np.zeros(len(h), bool)
        out[known] = d[known] > self.d[at]
        self.d[at] = np.minimum(self.d[at], d[known])
        new = np.flatnonzero(several & ~known)[: self.most]
        new = new[~np.isin(h[new], self.h)]  # one window for each h is enough to remember
        if len(self.h) + len(new) > self.most:
            self.__init__(self.most)
        to = np.searchsorted(self.h, h[new])
        self.h, self.c, self.d = np.insert(self.h, to, h[new]), np.insert(self.c, to, c[new]), np.insert(self.d, to, d[new])
        return out


def repeated_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """d, hs: the hashes of document d's windows that a document with a smaller id has, too."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = even_keys(docs.sparkSession, n)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Shared(MOST_SHARED)
        for b in slices(batches, "text", SLICE):
            w = Words(*flat(b.column(1)))
            words = w.hashes()
            h, _, rows = windows(words, w.bounds, size)
            c = (windows(mix(words ^ OTHER), w.bounds, size)[0] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            d = b.column(0).to_numpy(zero_copy_only=False)[rows]
            order = np.lexsort((d, c, h))
            h, c, d = h[order], c[order], d[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            keep = new.copy()
            keep[1:] |= d[1:] != d[:-1]
            settled, some = keep & ~new, np.flatnonzero(new)
            several = np.logical_or.reduceat(settled, some) if len(some) else new
            # A hash that stands for two windows of this slice (as good as never) is left to the exchange.
            single = np.ones(len(some), bool)
            single[1:] &= h[some[1:]] != h[some[:-1]]
            settled[some[single]] = shared.later(h[some[single]], c[some[single]], d[some[single]], several[single])
            for known, some in ((False, np.flatnonzero(new & ~settled)), (True, np.flatnonzero(settled))):
                if len(some):
                    keys = buckets[((d[some].astype(np.uint64) if known else h[some]) % np.uint64(n)).astype(np.int64)]
                    columns = packed(keys, d[some], h[some], c[some])
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(columns[0]), known))], ["bucket", "docs", "which", "hs", "cs", "known"])

    slim = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = slim.mapInArrow(put, "bucket int, docs array<long>, which array<tinyint>, hs array<long>, cs array<int>, known boolean").repartition(n, "bucket")
    each = rows.select("bucket", "known", "docs", "which", "cs", F.posexplode("hs").alias("at", "h"))
    each = each.select("h", F.get("cs", "at").alias("c"), "bucket", "known", F.get("docs", F.get("which", "at")).alias("d"))
    # What a slice has settled forms groups of its own, beside the hash's.
    first = F.min("d").over(W.partitionBy("h", "c", "bucket", F.when(F.col("known"), F.col("d"))))
    return each.withColumn("first", first).filter(F.col("known") | (F.col("d") > F.col("first"))).groupBy("d").agg(F.collect_list("h").alias("hs"))


def dedup_substrings(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """docs with shortened texts, n_words and n_removed, and spans: the removed intervals (first word, one after the last)."""
    found = table(repeated_windows(docs, size), "repeated")  # the windows' exchange goes before the texts' one
    docs = docs.drop(*RESULTS)
    names = docs.columns
    at = names.index("text")
    joined = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names))).join(found, F.col(f"c{names.index('doc_id')}") == F.col("d"), "left").drop("d")
    kinds = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(docs.schema)]
    span = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
    out_type = T.StructType([*kinds, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", span)])
    arrow_span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, f"c{at}"):
            text = b.column(at)
            data, offsets = flat(text)
            w = Words(data, offsets)
            hs = b.column(b.num_columns - 1)
            some = np.flatnonzero(hs.is_valid().to_numpy(zero_copy_only=False))
            removed, spans, texts = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)], text
            if len(some):
                h, first, rows = windows(w.hashes(), w.bounds, size)
                cuts = np.searchsorted(rows, np.arange(b.num_rows + 1))
                new = text.to_pylist()
                for i in some.tolist():
                    mine = slice(cuts[i], cuts[i + 1])
                    known = hs[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    begin = first[mine][np.isin(h[mine], known)] - w.bounds[i]
                    n = int(w.bounds[i + 1] - w.bounds[i])
                    marks = np.zeros(n + 1, np.int32)
                    np.add.at(marks, begin, 1)
                    np.add.at(marks, begin + size, -1)
                    gone = np.cumsum(marks) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[:n], [False]]).astype(np.int8)))
                    pairs = edges.reshape(-1, 2).tolist()
                    removed[i], spans[i] = int(gone[:n].sum()), [{"first": a, "last": z} for a, z in pairs]
                    # From a removed word up to the next word that stays.
                    starts = np.append(w.starts[w.bounds[i] : w.bounds[i + 1]], offsets[i + 1])
                    parts, done = [], offsets[i]
                    for a, z in pairs:
                        parts.append(data[done : starts[a]])
                        done = starts[z]
                    new[i] = np.concatenate([*parts, data[done : offsets[i + 1]]]).tobytes().decode()
                texts = pa.array(new, text.type)
            columns = list(b.columns[:-1])
            columns[at] = texts
            yield pa.RecordBatch.from_arrays([*columns, pa.array(w.counts()), pa.array(removed), pa.array(spans, arrow_span)], out_type.names)

    return joined.mapInArrow(cut, out_type).toDF(*names, *RESULTS)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(kept, "UTF-8"), 256).alias("kept_sha256"))
