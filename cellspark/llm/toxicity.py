"""Toxicity: a logistic classifier whose score must not change when identity terms are swapped.

Features are the words of a text and the beginnings of its longer words, as
64-bit hashes. Spark counts them over the labelled texts (at most MAX_LABELLED
of them, those with the smallest hash of doc_id: the sample's documented
bound); the clearest ones and all identity terms form the model. Training, in
numpy on the sample's sparse rows, adds to the logistic loss the squared change
of the score (as log-odds) between each labelled text with an identity term and the same text
with that term swapped for another of its group. A term that merely stands
beside toxic words thus gets the same weight as its group, and neutral mentions
stay below the bar. Scoring reads every whole text once; the weights are at
most MAX_FEATURES numbers.

* null or empty text: the score of a text without features. Very long texts:
  every word counts, once.
* No labels, or one class only: every score is that class's share (0 without any).
* Repeated labels: a document is toxic if one of its labels says so; null
  labels and labels of unknown documents don't count. Repeated rows and ties:
  equal texts, equal scores. Null doc_id: scored, never learned from.
* doc_id is a whole number where labels are learned from; scoring takes any type.
* An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, flat, mix, read, slices

MAX_LABELLED, MAX_FEATURES, LEAST_TEXTS, LEAST_Z = 20_000, 16_384, 6, 4.0
SWAP_WEIGHT, RIDGE, STEPS, BAR = 3.0, 3e-4, 300, 0.3
PREFIX = 5

#: Terms that may be swapped within their group.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "hispanic", "african", "european"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("immigrants", "refugees", "natives", "citizens"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("musulmans", "juifs", "chrétiens"),
    ("muslime", "juden", "christen"),
    ("musulmanes", "judíos", "cristianos"),
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[i for i in range(128) if not chr(i).isalnum()]] = 32


def text_features(data: np.ndarray, offsets: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of each row, one row after the other, and their rows.

    The words in terms (ascending hashes) have no beginnings, so that a swap replaces all that the model sees of them.
    """
    w = Words(_FOLD[data], offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), w.counts())
    h = w.hashes()
    long = np.flatnonzero((w.ends - w.starts > PREFIX) & ~np.isin(h, terms))
    w.starts, w.ends = w.starts[long], w.starts[long] + PREFIX
    h, rows = np.concatenate([h, mix(w.hashes() ^ np.uint64(0x5BD1E995))]), np.concatenate([rows, rows[long]])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[keep], rows[keep]


def term_hash(term: str) -> int:
    raw = np.frombuffer(term.encode(), np.uint8)
    return int(Words(_FOLD[raw], np.array([0, len(raw)])).hashes()[0])


@dataclass
class Model:
    """Feature hashes in ascending order, their weights, the log-odds of a text without any, and the identity terms' hashes."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    terms: np.ndarray

    def scores(self, h: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        z = np.full(n, self.bias)
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            z += np.bincount(rows[hit], self.weights[at[hit]], n)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(rows: np.ndarray, features: np.ndarray, labels: np.ndarray, n_features: int, groups: list[list[int]], swap_weight: float = SWAP_WEIGHT, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias from sparse rows (row, feature) by Adam on the whole sample; groups: swappable features."""
    n = len(labels)
    w, b = np.zeros(n_features), float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
    group_of = np.full(n_features, -1)
    for g, members in enumerate(groups):
        group_of[members] = g
    own = np.flatnonzero(group_of[features] >= 0)
    # Each identity term of a text, swapped for the others of its group in turn.
    swap_from = features[own]
    turn = np.arange(len(own))
    swap_to = np.array([(m := groups[group_of[f]])[(m.index(f) + 1 + t % max(len(m) - 1, 1)) % len(m)] for f, t in zip(swap_from.tolist(), turn.tolist(), strict=True)], np.int64)
    m1, m2 = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(rows, w[features], n)
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        slope = (p - labels) / n
        grad = np.bincount(features, slope[rows], n_features) + ridge * w
        grad_b = slope.sum()
        if len(own) and swap_weight:
            # The change of the log-odds by each swap: what bends the probability hides changes far from one half.
            change = 2 * swap_weight * (w[swap_to] - w[swap_from]) / len(own)
            grad += np.bincount(swap_to, change, n_features) - np.bincount(swap_from, change, n_features)
        g = np.append(grad, grad_b)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.1 * (1 - step / (steps + 1)) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES, swap_weight: float = SWAP_WEIGHT, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """A model from labels(doc_id, toxic) of documents; at most max_labelled texts and max_features features come to the driver."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("y"))
    ids = docs.select("doc_id").join(known, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    ids = ids.collect()  # max_labelled small rows at most
    if not ids or len({r["y"] > 0 for r in ids}) < 2:
        share = float(np.mean([r["y"] > 0 for r in ids])) if ids else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), 60.0 if share else -60.0, np.zeros(0, np.uint64))
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(r["doc_id"], float(r["y"] > 0)) for r in ids], "doc_id long, y double"))
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").select("text", "y")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = [[term_hash(t) for t in g] for g in terms]
    term_hashes = np.unique(np.array([t for g in groups for t in g], np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, rows = text_features(*flat(b.column(0)), term_hashes)
            y = b.column(1).to_numpy()[rows]
            each, which, n = np.unique(h, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(n), pa.array(np.bincount(which, y, len(each)))], ["h", "n", "toxic"])

    total, toxic = len(ids), sum(r["y"] > 0 for r in ids)
    counted = sample.mapInArrow(count, "h long, n long, toxic double").groupBy("h").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    share = toxic / total
    z = (F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    best = counted.filter(F.col("n") >= LEAST_TEXTS).withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "h").limit(max_features)
    chosen_h = np.array([r["h"] for r in best.select("h").collect()], np.int64).view(np.uint64)  # max_features rows at most
    hashes = np.unique(np.concatenate([chosen_h, term_hashes]))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, rows = text_features(*flat(b.column(0)), term_hashes)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            cuts = np.searchsorted(rows[hit], np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cuts), pa.array(at[hit].astype(np.int32))), b.column(1)], ["at", "y"])

    got = sample.mapInArrow(sparse, "at array<int>, y double").coalesce(parts).toArrow()
    lists = got.column("at").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows, labels_ = np.repeat(np.arange(len(sizes)), sizes), got.column("y").to_numpy()
    index = {int(h): i for i, h in enumerate(hashes)}
    weights, bias = fit(rows, lists.values.to_numpy(), labels_, len(hashes), [[index[t] for t in g] for g in groups], swap_weight)
    return Model(hashes, weights, bias, term_hashes)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, rows = text_features(*flat(b.column(1)), model.terms)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(h, rows, b.num_rows))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, f"doc_id {kind}, score double")


def keep_clean(docs: DataFrame, model: Model, bar: float = BAR) -> DataFrame:
    """docs whose text scores below the bar, with all their columns."""
    names, at = docs.columns, docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, rows = text_features(*flat(b.column(at)), model.terms)
            yield b.filter(pa.array(model.scores(h, rows, b.num_rows) < bar))

    return docs.mapInArrow(work, docs.schema).select(*names)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))), read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= BAR).cast("int").alias("predicted"))
