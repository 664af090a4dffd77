"""N-gram Jaccard join: all documents whose sets of word shingles have a similarity of at least `threshold`.

1. Shingles and MinHash. Each text's distinct shingles of five words (a shorter
   text is one shingle) give a 128-bit fingerprint of the whole set and 128
   MinHash values. Documents with the same set are one class: they are linked,
   and only the one with the smallest doc_id goes on, with the class's size.
2. Candidates. 32 bands of four values: two sets with a similarity of 0.8 share
   no band with probability (1 - 0.8^4)^32 = 4e-8.
   Bands with up to SMALL classes give pairs. The classes of larger bands are
   dealt out in blocks of bounded size, neighbours together, and pairs of blocks
   that have a band in common are compared in numpy: neither all pairs of a
   band nor all members in one task ever become rows.
3. Bayesian pruning. MinHash values are compared 16 at a time; a pair goes as
   soon as, under a uniform prior, the posterior probability that its similarity
   reaches the threshold is below `tolerance`.
4. What is left is verified exactly on the sets of shingle hashes.

* null or empty text: no shingles; such documents are one class and have no
  other links. Very long texts: all shingles count.
* Repeated rows and ties: each row counts as a document of its class. Rows with one doc_id and several texts belong to the
  classes of their texts; keep_one() keeps one row of each group, also of equal rows.
* doc_id is a whole number. Null doc_id: the row is left out. An empty table: no rows. Extra columns are
  ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, flat, mix, read, slices, table, windows
from .components import components

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
HASHES, BANDS, ROUND = 128, 32, 16
#: Classes in a band that are compared as pairs, and classes and shingles in a block of a larger one.
SMALL, BLOCK, BLOCK_SHINGLES = 6, 512, 1_000_000
SALTS = 16

_rng = np.random.default_rng(77)
_A, _B = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1), _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


# --------------------------------------------------------------- sets and hashes
def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and their bounds."""
    w = Words(data, offsets)
    words, n = w.hashes(), w.counts()
    h, _, rows = windows(words, w.bounds, size)
    for i in np.flatnonzero((n > 0) & (n < size)):
        own, _, _ = windows(words[w.bounds[i] : w.bounds[i + 1]], np.array([0, n[i]]), int(n[i]))
        h, rows = np.append(h, own), np.append(rows, i)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    if len(h):
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])])
        h, rows = h[keep], rows[keep]
    return h, np.searchsorted(rows, np.arange(len(offsets)))


def minhash(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HASHES values per row; rows without shingles have the largest value throughout."""
    out = np.full((len(bounds) - 1, HASHES), 2**32 - 1, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return out
    x = (h >> np.uint64(32)).astype(np.uint32)
    y, begin = np.empty_like(x), bounds[:-1][some]
    for k in range(HASHES):
        np.multiply(x, _A[k], out=y)
        y ^= _B[k]
        out[some, k] = np.minimum.reduceat(y, begin)
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """BANDS hashes per row, each of the band's number and its values."""
    v = signatures.reshape(len(signatures), BANDS, -1).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None].repeat(len(v), 0)
    for k in range(v.shape[2]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + v[:, :, k])
    return out


def fingerprints(h: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """128 bits of each row's set of shingle hashes."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(s)))]) for s in (0x1234567, 0x89ABCDEF01)]
    return [pa.array((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64)) for x in sums]


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """id, t (a hash of the text), f1, f2 (the set's fingerprint), n (shingles), sig, bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, bounds = shingle_sets(*flat(b.column(2)), size)
            sig = minhash(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], *fingerprints(h, bounds), pa.array(np.diff(bounds)), pa.array([x.tobytes() for x in sig], pa.binary()), pa.FixedSizeListArray.from_arrays(pa.array(bands(sig).view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))],
                ["id", "t", "f1", "f2", "n", "sig", "bands"],
            )

    slim = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), text_hash().alias("t"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(work, "id long, t long, f1 long, f2 long, n long, sig binary, bands array<long>")


def sets_of(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """id, set: the shingle hashes, 8 bytes each, of classes(id, doc, f1, f2), from a document of each; other texts with its doc_id are passed over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, bounds = shingle_sets(*flat(b.column(1)), size)
            yield pa.RecordBatch.from_arrays([b.column(0), *fingerprints(h, bounds), pa.array([h[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["doc", "f1", "f2", "set"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(classes.select("doc").hint("shuffle_hash"), "doc", "left_semi")
    found = slim.mapInArrow(work, "doc long, f1 long, f2 long, set binary")
    return found.join(classes.select("id", "doc", "f1", "f2"), ["doc", "f1", "f2"]).select("id", "set").dropDuplicates(["id"])


# --------------------------------------------------------------------- pruning
def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones to go on), from a uniform prior on the similarity."""
    grid = np.linspace(0, 1, 4001)[1:-1]
    out = []
    for n in range(ROUND, HASHES + 1, ROUND):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                out.append((n, m))
                break
    return out


def likely(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs of signatures that survive all rounds; a pair's values are read only while it does."""
    alive, equal, at = np.arange(len(left)), np.zeros(len(left), np.int16), 0
    for n, least in steps:
        equal = equal + (left[alive, at:n] == right[alive, at:n]).sum(1, dtype=np.int16)
        keep = equal >= least
        alive, equal, at = alive[keep], equal[keep], n
    return alive


def needed(a: int, b: int, threshold: float) -> int:
    """The fewest common members for a similarity of threshold (a hair below, for rounding)."""
    return math.ceil(threshold * (a + b) / (1 + threshold) - 1e-9)


# ------------------------------------------------------------------------ pairs
def small_pairs(members: DataFrame) -> DataFrame:
    """a < b: distinct pairs of classes in bands of at most SMALL."""
    ids = members.groupBy("band").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    each = ids.select("ids", F.posexplode("ids").alias("i", "a"))
    return each.select("a", F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("b")).distinct()


def salted(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def for_salts(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def blocks_of(members: DataFrame, classes: DataFrame) -> DataFrame:
    """id, block: the classes of members(band, id), dealt out in blocks of bounded size.

    Classes that share a band with the same smallest id are neighbours: their
    blocks hold nobody else.
    """
    # A band may hold a third of all classes: its members are dealt out by salt, and its one row goes to each.
    lowest = for_salts(members.groupBy("band").agg(F.min("id").alias("centre")))
    near = salted(members.select("band", "id"), "id").join(lowest, ["band", "salt"]).groupBy("id").agg(F.min("centre").alias("centre"))
    near = table(near.join(classes.select("id", "n"), "id"), "centres")
    sizes = near.groupBy("centre").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    dealt = salted(near, "id").join(for_salts(sizes), ["centre", "salt"])
    return dealt.select("id", F.concat_ws("/", "centre", F.pmod(F.xxhash64("id"), "blocks")).alias("block"))


def block_pairs(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """i <= j: distinct pairs of blocks(id, block) that have a band of members(band, id) in common."""
    met = table(members.select("band", "id").join(blocks, "id").select("band", "block").distinct(), "band-blocks")
    several = met.join(met.groupBy("band").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high").select("band"), "band", "left_semi")
    one, other = several.withColumnRenamed("block", "i"), several.withColumnRenamed("block", "j")
    return blocks.select(F.col("block").alias("i"), F.col("block").alias("j")).union(one.join(other, "band").filter("i < j").select("i", "j")).distinct()


def pruned(pairs: DataFrame, classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    steps = least_matches(threshold, tolerance)
    side = lambda k: classes.select(F.col("id").alias(k), F.col("sig").alias(f"sig_{k}"), F.col("n").alias(f"n_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter((F.col("n_a") >= threshold * F.col("n_b") - 1e-9) & (F.col("n_b") >= threshold * F.col("n_a") - 1e-9))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                left, right = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint32).reshape(-1, HASHES) for k in (2, 3))
                yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).take(pa.array(likely(left, right, steps)))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    side = lambda k: sets.select(F.col("id").alias(k), F.col("set").alias(f"set_{k}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(iter([big]), "set_a", 8_000_000):
                keep = []
                for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    if len(x) and int((x[at] == y).sum()) >= needed(len(x), len(y), threshold):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(work, "a long, b long")


# ----------------------------------------------------------------------- blocks
def compare_blocks(pdf: pd.DataFrame, threshold: float, steps: list[tuple[int, int]]) -> pd.DataFrame:
    """One pair of blocks: each class's links (classes and documents), and edges that span what is linked."""
    i, j = pdf.i.iloc[0], pdf.j.iloc[0]
    pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
    x = pdf[pdf.block == i].reset_index(drop=True)
    y = x if i == j else pdf[pdf.block == j].reset_index(drop=True)
    unpack = lambda p: np.frombuffer(b"".join(p.sig), np.uint32).reshape(-1, HASHES)
    sx, sy, nx, ny = unpack(x), unpack(y), x.n.to_numpy(), y.n.to_numpy()
    sets_y = [np.frombuffer(s, np.uint64) for s in y.set]
    # Positions of y's members by shingle: one sorted list for the whole block.
    members = np.concatenate(sets_y) if len(sets_y) else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(sets_y)), [len(s) for s in sets_y])
    order = np.argsort(members, kind="stable")
    members, owners = members[order], owners[order]
    links, docs = np.zeros((2, max(len(x), len(y))), np.int64), np.zeros((2, max(len(x), len(y))), np.int64)
    root = np.arange(len(x) + len(y))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    edges = []
    ids_x, ids_y, cx, cy = x.id.to_numpy(), y.id.to_numpy(), x.copies.to_numpy(), y.copies.to_numpy()
    for a in range(len(x)):
        others = np.arange(a + 1 if i == j else 0, len(y))
        others = others[(nx[a] >= threshold * ny[others] - 1e-9) & (ny[others] >= threshold * nx[a] - 1e-9)]
        others = others[likely(np.broadcast_to(sx[a], (len(others), HASHES)), sy[others], steps)]
        if not len(others):
            continue
        own = np.frombuffer(x.set.iloc[a], np.uint64)
        lo, hi = np.searchsorted(members, own), np.searchsorted(members, own, side="right")
        total = int((hi - lo).sum())
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange(total)
        common = np.bincount(owners[at], minlength=len(y))[others]
        least = np.ceil(threshold * (nx[a] + ny[others]) / (1 + threshold) - 1e-9)
        others = others[common >= least]
        links[0, a] += len(others)
        docs[0, a] += cy[others].sum()
        links[1, others] += 1
        docs[1, others] += cx[a]
        for b in others.tolist():
            p, q = find(a), find(b if i == j else len(x) + b)
            if p != q:
                root[max(p, q)] = min(p, q)
                edges.append((ids_x[a], ids_y[b]))
    out = pd.DataFrame({"id": np.concatenate([ids_x, ids_y]), "links": np.concatenate([links[0, : len(x)], links[1, : len(y)]]), "docs": np.concatenate([docs[0, : len(x)], docs[1, : len(y)]])})
    out = out[out.links > 0].assign(other=pd.NA)
    tree = pd.DataFrame(edges, columns=["id", "other"]).assign(links=0, docs=0)
    both = pd.concat([out, tree]) if len(tree) else out
    return both.astype({"id": "int64", "links": "int64", "docs": "int64", "other": "Int64"})[["id", "other", "links", "docs"]]


def block_links(blocks: DataFrame, pairs: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """id, other, links, docs (see compare_blocks) for the pairs(i, j) of blocks(id, block)."""
    steps = least_matches(threshold, tolerance)
    wanted = pairs.withColumn("block", F.col("i")).union(pairs.filter("i < j").withColumn("block", F.col("j")))
    rows = blocks.join(classes.select("id", "n", "copies", "sig"), "id").join(sets, "id").join(wanted, "block")
    return rows.groupBy("i", "j").applyInPandas(lambda pdf: compare_blocks(pdf, threshold, steps), "id long, other long, links long, docs long")


# ------------------------------------------------------------------------- join
def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """id, t, set_id (smallest id with the same shingles), class_id (smallest id of all that links reach), n_links (other documents that reach the threshold), n_set_links (other sets), first (its set is the one of class_id).

    Classes of equal sets have numbers of their own in here: rows that share a doc_id but not their text are kept apart.
    """
    sig = table(signatures(docs, words), "signatures")
    classes = sig.groupBy("f1", "f2").agg(F.min_by(F.struct(F.col("id").alias("doc"), "n", "sig", "bands"), "id").alias("r"), F.count("*").alias("copies"))
    classes = table(classes.select(F.monotonically_increasing_id().alias("id"), "f1", "f2", "copies", "r.*"), "classes")
    banded = classes.filter("n > 0").select("id", F.explode("bands").alias("band"))
    full = table(banded.join(banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"), "band"), "bands")
    large = full.filter(F.col("size") > SMALL)
    blocks = table(blocks_of(large, classes), "blocks")
    together = table(block_pairs(large, blocks), "block-pairs")
    # Pairs of classes whose blocks are compared anyway are left to these.
    a, b = (blocks.select(F.col("id").alias(k), F.col("block").alias(f"block_{k}")) for k in ("a", "b"))
    pairs = small_pairs(full.filter(F.col("size") <= SMALL)).join(a, "a", "left").join(b, "b", "left").withColumns({"i": F.least("block_a", "block_b"), "j": F.greatest("block_a", "block_b")})
    pairs = pairs.filter("block_a is null or block_b is null").select("a", "b").union(pairs.filter("block_a is not null and block_b is not null").join(together, ["i", "j"], "left_anti").select("a", "b"))
    pairs = table(pruned(pairs, classes, threshold, tolerance), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(blocks.select("id")).distinct()
    sets = table(sets_of(docs, table(classes.select("id", "doc", "f1", "f2").join(wanted, "id"), "wanted"), words), "sets")
    pairs = table(verified(pairs, sets, threshold), "verified")
    inside = table(block_links(blocks, together, classes, sets, threshold, tolerance), "linked")
    copies = classes.select("id", "copies")
    ends = pairs.union(pairs.select("b", "a")).toDF("id", "other").join(copies.withColumnRenamed("id", "other"), "other")
    links = ends.select("id", F.lit(1).cast("long").alias("links"), F.col("copies").alias("docs")).union(inside.select("id", "links", "docs")).groupBy("id").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    edges = pairs.union(inside.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    labels = components(edges).select(F.col("v").alias("id"), "label")
    # The smallest document of each component; of several sets with its doc_id, the one with the smaller fingerprint.
    named = table(labels.join(classes.select("id", "doc", "f1", "f2"), "id"), "labels")
    least = for_salts(named.groupBy("label").agg(F.min(F.struct("doc", "f1", "f2", "id")).alias("least")))
    named = salted(named, "id").join(least, ["label", "salt"]).select("id", F.col("least.doc").alias("class_id"), (F.col("least.id") == F.col("id")).alias("first"))
    full_classes = classes.select("f1", "f2", "id", "doc", "copies").join(links, "id", "left").join(named, "id", "left")
    full_classes = full_classes.select("f1", "f2", F.col("doc").alias("set_id"), F.coalesce("class_id", "doc").alias("class_id"), (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("links", F.lit(0)).cast("long").alias("n_set_links"), F.coalesce("first", F.lit(True)).alias("first"))
    return sig.select("id", "t", "f1", "f2").join(full_classes, ["f1", "f2"]).drop("f1", "f2")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group that links, direct or not, hold together: one with the smallest doc_id; rows without doc_id stay."""
    found = jaccard_join(docs, **options)
    # Rows with one doc_id and one text are judged alike.
    rows = table(found.groupBy(F.col("id").alias("doc_id"), "t").agg(F.bool_or((F.col("id") != F.col("class_id")) | ~F.col("first")).alias("gone"), F.count("*").alias("n")).filter("gone or n > 1"), "judged")
    marked = docs.withColumn("__text_hash", text_hash())
    out = marked.join(rows.select("doc_id", F.col("t").alias("__text_hash")), ["doc_id", "__text_hash"], "left_anti").select(docs.columns)
    twice = rows.filter("not gone").select("doc_id", F.col("t").alias("__text_hash"))
    if not twice.isEmpty():
        out = out.unionByName(marked.join(twice, ["doc_id", "__text_hash"], "left_semi").dropDuplicates(["doc_id", "__text_hash"]).select(docs.columns))
    return out


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "set_id", "class_id", "n_links", "n_set_links")
