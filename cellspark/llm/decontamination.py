"""Benchmark decontamination: items that occur in documents with at most a share of edits.

Item and text are compared in lower case with single blanks. An item of n
characters may have k = n * error edits (insertions, deletions, replacements).
Split into k + 1 pieces, at least one piece must occur unchanged; an automaton
of all pieces finds these hits in one pass over each text. A hit fixes where the
item would begin, give or take k; there Myers' bit-parallel algorithm computes
the smallest distance of the whole item to any stretch of the text.

The items are dealt out in blocks of about BLOCK_BYTES (texts of one item_id stay
together); each block is one pass over the documents, so that what goes to the
workers has a bound at any size of the benchmark. Benchmarks are small beside a
corpus: one of 1 GB would mean 250 passes.

* null or empty text, null or empty items (or of blanks only): no match.
* Very long texts: searched whole. Items longer than a text: never match
  beyond their budget.
* Ties: of equal distances the first place counts. Repeated item rows: one
  result per item_id, its best text. Repeated documents: a result for each row.
* Null item_id or doc_id: kept as null in the results; a filter judges each row by its own text. An empty table: no rows.
* item_id is a whole number; doc_id may have any type. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, table

ERROR, BLOCK_BYTES = 0.08, 4 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(n: int, error: float) -> int:
    return int(n * error)


def cut_pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of near equal length, with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], n: int, text: str) -> tuple[int, int]:
    """The smallest edit distance of an item of n > 0 characters to any stretch of text, and where the first such ends."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = full, 0, n
    best, end = n, 0
    for at, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, at + 1
    return best, end


class Matcher:
    """The automaton of all pieces of some items, and the check of its hits."""

    def __init__(self, items: list[tuple[int, str]], error: float):
        import ahocorasick

        self.items = [(i, t, budget(len(t), error), masks(t)) for i, t in items]
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t, most, _) in enumerate(self.items):
            for at, piece in cut_pieces(t, most):
                by_piece.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in by_piece.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> dict[int, tuple[int, int]]:
        """item: (distance, where its match ends in the normal text)."""
        found: dict[int, tuple[int, int]] = {}
        seen: dict[int, tuple[int, int]] = {}  # the stretch in which an item was checked last
        for last, (n, uses) in self.automaton.iter(text):
            for k, at in uses:
                _, item, most, peq = self.items[k]
                begin = last + 1 - n - at
                if k in found and found[k][0] == 0:
                    continue
                if begin >= 0 and text.startswith(item, begin):
                    found[k] = (0, begin + len(item))
                    continue
                # The stretch for this hit, and somewhat more, so that the next hits needn't be checked again.
                lo, hi = max(0, begin - most), begin + len(item) + most
                done = seen.get(k, (0, -1))
                if most == 0 or done[0] <= lo and hi <= done[1]:
                    continue
                lo, hi = max(0, lo - most), hi + most
                seen[k] = (lo, hi)
                distance, end = myers(peq, len(item), text[lo:hi])
                if distance <= most and (k not in found or distance < found[k][0]):
                    found[k] = (distance, lo + end)
        return found


_matchers: dict[int, Matcher] = {}


def blocks_of(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items as (item_id, normal text), in blocks of about block_bytes."""
    items = items.filter(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0).select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()  # a block: its size was counted before
        block = sorted(((r["item_id"], t) for r in rows if (t := normal(r["text"]))), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        if block:
            yield block


def find_items(docs: DataFrame, items: DataFrame, error: float = ERROR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, at (end of the match in the normal text): the best match of each item in each document."""
    out_type = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, distance int, at int"
    slim = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    found = docs.sparkSession.createDataFrame([], out_type)
    for block in blocks_of(items, block_bytes):
        found = found.unionByName(slim.mapInArrow(search(block, error), out_type))
    return found


def keep_clean(docs: DataFrame, items: DataFrame, error: float = ERROR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without those in which an item occurs, with all their columns."""
    at = docs.columns.index("text")
    for k, block in enumerate(blocks_of(items, block_bytes)):
        if k:  # one pass after the other, not all at once in each task
            docs = table(docs, "decontaminated")

        def work(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            found = matcher_of(block, error)
            for b in slices(batches, "text"):
                yield b.filter(pa.array([not found.matches(normal(t or "")) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def matcher_of(block: list[tuple[int, str]], error: float) -> Matcher:
    """This worker's automaton for a block; tasks that it runs later find it built."""
    key = hash((tuple(block), error))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(block, error)
    return _matchers[key]


def search(block: list[tuple[int, str]], error: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(block, error)
        for b in slices(batches, "text"):
            rows = []
            for i, text in enumerate(b.column(1).to_pylist()):
                best: dict[int, tuple[int, int]] = {}
                for k, hit in matcher.matches(normal(text)).items():
                    name = block[k][0]
                    best[name] = min(best.get(name, hit), hit)
                rows += [(i, name, *hit) for name, hit in best.items()]
            doc, item, distance, end = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc, pa.int64())), pa.array(item, pa.int64()), pa.array(distance, pa.int32()), pa.array(end, pa.int32())], ["doc_id", "item_id", "distance", "at"])

    return work


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
