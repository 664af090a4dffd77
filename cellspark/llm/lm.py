"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation, beside a unigram base.

Tokens are lower-cased words and an end. All frequent words have a vector of
their own as context and as target; rarer words have one by their ending. The
model predicts a token's class from the CONTEXT tokens before it, and then the
word within its class: the TOP most frequent words are classes of their own,
the other frequent words are dealt into groups of GROUP words at most, smaller
ones for more frequent words, and rarer words fall into classes by their ending, whose words share its probability by
their counts. Each position of the context has weights of its own (a diagonal
matrix). Scores are normalised by matrix products over all classes, and over all
words of a group for the tokens of that group.

Passes over the texts, all of them over whole texts and all documents:

1. exact counts of all words: tasks sum up what they hold, then one exchange.
   The FREQUENT largest of those with LEAST tokens or more get vectors, the
   largest of them become classes, and workers get the counts of KNOWN words
   at most;
2. training in ROUNDS rounds, each over its own share of the documents: workers
   run stochastic gradient descent with noise-contrastive estimation from the
   same start, and Spark averages parameters and step sizes, each word's
   weighted by the tokens it was learned from, for the next round;
3. scores of each document's classes and of the words whose counts workers have;
   its other words join the table of counts.

Pass 2 deals documents out by a hash of doc_id and text to as many workers as
there are WORKER_BYTES of text (MOST_WORKERS at most, which then have more of
it), in the order of that hash: the model depends on the documents alone, not
on files or partitions.

* null or empty text: the end alone. Very long texts: every token counts.
* Repeated rows and ties: each row is a document of its own, also with an equal
  doc_id. Null doc_id: learned from and scored. No training documents: the base
  is that of no counts (0), the model's classes are equally likely.
* An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, even_keys, exchanges_deleted, flat, read, slices, table

TOP, FREQUENT, LEAST, KNOWN = 64, 65_536, 5, 524_288
#: Words that a task sorts in one go, and distinct ones that it holds before it hands them on.
SORTED, HELD = 4_000_000, 1_000_000
CONTEXT, WIDTH, NOISE, BATCH, RATE, SEED = 3, 16, 32, 2048, 0.15, 5
ROUNDS, WORKER_BYTES, MOST_WORKERS = 3, 48_000_000, 4096
ENDINGS, GROUP, BLOCK, WORD_BATCH, CACHED = 60, 2048, 256, 512, 200_000
LN10 = np.log(10.0)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDING = np.full(256, 28, np.int64)
_ENDING[97:123] = np.arange(26)
_ENDING[[46, 44]] = 26, 27
_ENDING[128:] = 29


# ---------------------------------------------------------------------- tokens
class Texts:
    """Words of a slice of texts: 58 bits of their hashes, followed by their endings, which are their classes unless they are frequent."""

    def __init__(self, col: pa.Array):
        data, offsets = flat(col)
        data = _LOWER[data]
        w = Words(data, offsets)
        self.bounds, self.n = w.bounds, len(offsets) - 1
        wide = np.concatenate([[0], np.cumsum(data >= 128)])
        self.endings = _ENDING[data[w.ends - 1]] + 30 * (wide[w.ends] > wide[w.starts])
        self.h = (w.hashes() | np.uint64(63)) - np.uint64(63) + self.endings.astype(np.uint64)
        self.rows = np.repeat(np.arange(self.n), np.diff(w.bounds))


@dataclass
class Counts:
    """Frequent words by hash in ascending order, with their training counts and classes; class counts; documents.

    others, other_counts: words without vectors whose counts are at hand, by hash in ascending order; distinct: words without
    vectors by ending.
    """

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    top: int
    class_counts: np.ndarray
    docs: int
    others: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    other_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    distinct: np.ndarray = field(default_factory=lambda: np.zeros(ENDINGS, np.int64))

    def __post_init__(self) -> None:
        # A word's slot: its place when words are ordered by class; class k has the slots from starts[k] to starts[k + 1].
        order = np.argsort(self.classes, kind="stable")
        self.slots = np.empty(len(order), np.int64)
        self.slots[order] = np.arange(len(order))
        self.starts = np.searchsorted(self.classes[order], np.arange(len(self.class_counts) + 1))
        # A word's share of its class, by slot.
        self.shares, sizes = self.counts[order] + 0.5, np.diff(self.starts)
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.shares /= np.bincount(of, self.shares, len(sizes))[of]

    @property
    def end(self) -> int:
        return self.top + ENDINGS

    def look(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Of each word: its place among the frequent ones, or -1; its class."""
        classes = self.top + t.endings
        at = found(self.hashes, t.h)
        return at, np.where(at >= 0, self.classes[at], classes) if len(self.hashes) else classes

    def sequence(self, t: Texts, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens with ends: the class, the context before (CONTEXT columns: frequent words, endings, the end), the row, and the slot or -1."""
        words = len(self.hashes)
        here = np.arange(len(classes)) + t.rows
        seq, slot, own = np.full(len(classes) + t.n, self.end, np.int16), np.full(len(classes) + t.n, -1), np.full(len(classes) + t.n, words + ENDINGS, np.int32)
        seq[here] = classes
        if words:
            slot[here] = np.where(at >= 0, self.slots[at], -1)
        own[here] = np.where(at >= 0, at, words + t.endings)
        row = np.repeat(np.arange(t.n), np.diff(t.bounds) + 1)
        start = (t.bounds[:-1] + np.arange(t.n))[row]
        i = np.arange(len(seq))
        before = np.stack([np.where(i - j >= start, own[np.maximum(i - j, 0)], words + ENDINGS) for j in range(1, CONTEXT + 1)], 1) if len(seq) else np.zeros((0, CONTEXT), np.int32)
        return seq, before, row, slot

    def grouped(self, seq: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Groups with tokens, and where these are."""
        some = np.flatnonzero(seq > self.end)
        some = some[np.argsort(seq[some], kind="stable")]
        cuts = np.searchsorted(seq[some], np.arange(self.end + 1, len(self.class_counts) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            yield self.end + 1 + int(k), some[cuts[k] : cuts[k + 1]]


def in_training(doc_id: Column) -> Column:
    return ~F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 7 == 2, F.lit(False))


def dealt(training: DataFrame, workers: int, nth: int = 0, of: int = 1) -> DataFrame:
    """The nth of so many shares of training(doc_id, text), dealt out to workers in an order that only the rows decide."""
    keyed = training.select("text", F.xxhash64("doc_id", "text").alias("key")).filter(F.pmod("key", F.lit(of)) == nth)
    # One key per worker, each of which has a partition of its own, also where a session has more partitions than workers.
    numbers = F.array(*(F.lit(int(k)) for k in even_keys(training.sparkSession, workers)))
    keyed = keyed.withColumn("worker", F.get(numbers, F.pmod(F.shiftright("key", 20), F.lit(workers)).cast("int")))
    return keyed.repartition(workers, "worker").sortWithinPartitions("worker", "key", "text").select("text")


def found(line: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Of each h its place in an ascending line, or -1."""
    if not len(line):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(line, h), len(line) - 1)
    return np.where(line[at] == h, at, -1)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct h of several (h, n) and the sum of each one's n."""
    if len(parts) == 1:
        return parts[0]
    h, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(n[order], first)


def word_counts(training: DataFrame, at_once: int = SORTED, most: int = HELD) -> DataFrame:
    """h, n: each distinct word of training(text) and its tokens, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new: list[np.ndarray] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sort() -> None:
            h = np.sort(np.concatenate(new)) if new else np.zeros(0, np.uint64)
            if len(h):
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                held.append((h[first], np.diff(np.append(first, len(h)))))
            new.clear()

        def rows() -> pa.RecordBatch:
            h, n = merged(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

        for b in slices(batches, "text"):
            new.append(Texts(b.column(0)).h)
            if sum(map(len, new)) < at_once:
                continue
            sort()
            # What is held is merged when there is twice as much as may stay, and handed on if it is too much even then.
            if sum(len(h) for h, _ in held) >= 2 * most:
                held[:] = [merged(held)]
                if len(held[0][0]) >= most:
                    yield rows()
        sort()
        if held:
            yield rows()

    return training.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def most_frequent(words: DataFrame, most: int) -> pa.Table:
    """h, n of the most frequent of words(h, n), `most` at most, by falling n.

    Counts fall into classes 1.1 % wide, exact ones below 64; whole classes are taken from the largest down, and of the class
    that doesn't fit the words in bins of their hashes that still do. Only histograms and what is taken reach the driver.
    """
    words = words.withColumn("size", F.floor(F.log2("n") * 64)).withColumn("bin", F.shiftrightunsigned("h", 52))
    sizes = np.array([(r["size"], r["rows"]) for r in words.groupBy("size").agg(F.count("*").alias("rows")).orderBy(F.desc("size")).collect()], np.int64).reshape(-1, 2)  # 64 * 63 rows at most
    fit = int(np.searchsorted(np.cumsum(sizes[:, 1]), most, side="right"))
    take = F.lit(fit == len(sizes))
    if fit < len(sizes):
        edge, left = int(sizes[fit, 0]), most - int(sizes[:fit, 1].sum())
        bins = words.filter(F.col("size") == edge).groupBy("bin").agg(F.count("*").alias("rows")).orderBy("bin").collect()  # 4096 rows at most
        fits = int(np.searchsorted(np.cumsum([r["rows"] for r in bins]), left, side="right"))
        take = (F.col("size") > edge) | (F.col("size") == edge) & (F.col("bin") < F.lit(int(bins[fits]["bin"]) if fits < len(bins) else 4096))
    got = words.filter(take).select("h", "n").toArrow()  # `most` rows at most
    return got.take(np.lexsort((got.column("h").to_numpy(), -got.column("n").to_numpy())))


def vocabulary(training: DataFrame, docs: int) -> tuple[Counts, DataFrame]:
    """Words and classes of training(text), which has so many documents, and the table of all word counts."""
    words = table(word_counts(training), "lm-words")
    totals, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in words.groupBy(F.col("h").bitwiseAND(63).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # ENDINGS rows at most
        totals[r["ending"]], distinct[r["ending"]] = r["n"], r["words"]
    best = most_frequent(words, KNOWN)
    h, n = best.column("h").to_numpy().view(np.uint64), best.column("n").to_numpy()
    size = min(FREQUENT, int((n >= LEAST).sum()))
    other = size + np.argsort(h[size:])
    others, other_counts = h[other], n[other]
    h, n = h[:size], n[:size]
    e = (h & np.uint64(63)).astype(np.int64)
    np.subtract.at(totals, e, n)
    np.subtract.at(distinct, e, 1)
    top = min(TOP, size)
    # Groups: words with the same ending, by falling counts. A group costs each of its tokens its size, and all tokens one class
    # more, which is least in sum where groups of s words with the share p of the tokens each have s * sqrt(p) = 1.
    rest = top + np.argsort(e[top:], kind="stable")
    first = np.searchsorted(e[rest], e[rest])
    roots = np.sqrt(n[rest] / max(1, totals.sum() + n.sum() + docs))
    before = np.cumsum(roots) - roots
    place = np.arange(len(rest)) - first
    new = np.diff(np.stack([e[rest], (before - before[first]).astype(np.int64), place // GROUP], 1), axis=0, prepend=-1).any(1)
    classes = np.arange(size)
    classes[rest] = top + ENDINGS + np.cumsum(new)
    groups = np.bincount(classes[rest] - top - ENDINGS - 1, n[rest]).astype(np.int64)
    order = np.argsort(h)
    return Counts(h[order], n[order], classes[order], top, np.concatenate([n[:top], totals, [docs], groups]), docs, others, other_counts, distinct), words


# ----------------------------------------------------------------------- model
@dataclass
class Model:
    """Representations (context), position weights; predicted features and bias by class, and by slot of the words in groups."""

    r: np.ndarray
    c: np.ndarray
    q: np.ndarray
    b: np.ndarray
    wq: np.ndarray
    wb: np.ndarray

    @classmethod
    def start(cls, counts: Counts) -> Model:
        rng, k, words = np.random.default_rng(SEED), len(counts.class_counts), len(counts.hashes)
        p = (counts.class_counts + 0.5) / (counts.class_counts.sum() + 0.5 * k)
        some = lambda n: rng.normal(0, 0.1, (n, WIDTH)).astype("f4")
        return cls(some(words + ENDINGS + 1), np.full((CONTEXT, WIDTH), 0.5, "f4"), some(k), np.log(p).astype("f4"), some(words), np.log(counts.shares).astype("f4"))

    def rows(self) -> np.ndarray:
        """All parameters in rows of WIDTH, and a bias or 0."""
        bias = np.concatenate([np.zeros(len(self.r) + CONTEXT, "f4"), self.b, self.wb])
        return np.column_stack([np.concatenate([self.r, self.c, self.q, self.wq]), bias])

    def filled(self, rows: np.ndarray) -> Model:
        r, c, q, wq = np.split(rows.astype("f4"), np.cumsum([len(self.r), CONTEXT, len(self.q)]))
        return Model(r[:, :WIDTH].copy(), c[:, :WIDTH].copy(), q[:, :WIDTH].copy(), q[:, WIDTH].copy(), wq[:, :WIDTH].copy(), wq[:, WIDTH].copy())

    def expected(self, before: np.ndarray) -> np.ndarray:
        out = self.r.take(before[:, 0], axis=0)
        out *= self.c[0]
        for j in range(1, CONTEXT):
            more = self.r.take(before[:, j], axis=0)
            more *= self.c[j]
            out += more
        return out

    def log_probabilities(self, seq: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log of each token's class probability, normalised over all classes."""
        return normalised(self.expected(before), seq, self.q, self.b)

    def log_word_probabilities(self, counts: Counts, seq: np.ndarray, before: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability: its class's, and in a group the word's, normalised over the group."""
        x = self.expected(before)
        out = normalised(x, seq, self.q, self.b)
        for k, at in counts.grouped(seq):
            lo, hi = counts.starts[k], counts.starts[k + 1]
            out[at] += normalised(x[at], slot[at] - lo, self.wq[lo:hi], self.wb[lo:hi])
        return out


def normalised(x: np.ndarray, want: np.ndarray, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each row's wanted column under scores x q + b."""
    out = np.empty(len(want))
    if not len(want):
        return out
    # No sum of scores overflows, unless parameters have grown beyond all measure.
    bound = np.linalg.norm(x, axis=1).max() * np.linalg.norm(q, axis=1).max() + np.abs(b).max()
    x, q = np.column_stack([x, np.ones(len(x), "f4")]), np.column_stack([q, b]).astype("f4")
    out[:] = np.einsum("ij,ij->i", x, q.take(want, axis=0))
    # So many rows at once that their scores stay in the processor's cache.
    many = max(16, CACHED // len(q))
    columns, ones, room = np.ascontiguousarray(q.T), np.ones(len(q), "f4"), np.empty((many, len(q)), "f4")
    for i in range(0, len(want), many):
        s = np.matmul(x[i : i + many], columns, out=room[: len(want[i : i + many])])
        if bound > 80:
            most = s.max(1)
            s -= most[:, None]
            out[i : i + many] -= most
        out[i : i + many] -= np.log(np.exp(s, out=s) @ ones)
    return out


def row_sums(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of at, and the sums of their values."""
    # Rows and places are sorted as one number, which is faster than sorting places by rows.
    bits = max(1, (len(at) - 1).bit_length())
    key = np.left_shift(at, bits, dtype=np.int64)
    key |= np.arange(len(at))
    key.sort()
    order, at = key & ((1 << bits) - 1), key >> bits
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(values.take(order, axis=0), first, axis=0)


class Trainer:
    """Noise-contrastive estimation with AdaGrad; each batch shares its noise: classes, and for a group its words.

    start: all parameters and their sums of squared gradients, as rows() gives them.
    """

    def __init__(self, model: Model, counts: Counts, seed: int = SEED, start: np.ndarray | None = None):
        # Rows of rare words move seldom, so that they start with longer steps.
        squares = Model(*(np.full_like(x, v) for x, v in zip((model.r, model.c, model.q, model.b, model.wq, model.wb), (1e-7, 1e-4, 1e-4, 1e-4, 1e-4, 1e-2), strict=True)))
        if start is not None:
            model, squares = model.filled(start[:, : WIDTH + 1]), model.filled(start[:, WIDTH + 1 :])
        self.m, self.counts, self.squares = model, counts, squares
        p = (counts.class_counts + 0.5) / (counts.class_counts.sum() + 0.5 * len(model.b))
        self.log_noise, self.cumulated = np.log(NOISE * p).astype("f4"), np.cumsum(p)
        self.word_noise, self.word_cumulated = np.log(NOISE * counts.shares).astype("f4"), np.concatenate([[0], np.cumsum(counts.shares)])
        self.rng = np.random.default_rng(seed)
        self.r_sq, self.wq_sq, self.wb_sq = squares.r, squares.wq, squares.wb
        self.sq = [squares.c, squares.q, squares.b]

    def rows(self) -> np.ndarray:
        return np.column_stack([self.m.rows(), self.squares.rows()])

    def contrast(self, x: np.ndarray, want: np.ndarray, noise: np.ndarray, q: np.ndarray, b: np.ndarray, log_noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the loss by x, by some of q's rows, which these are, and by b."""
        qw, qn = q.take(want, axis=0), q[noise]
        right = np.einsum("ij,ij->i", x, qw) + b[want] - log_noise[want]
        e_right = -1 / (1 + np.exp(np.minimum(right, 30)))
        e_wrong = x @ -qn.T
        e_wrong -= b[noise] - log_noise[noise]
        np.exp(np.minimum(e_wrong, 30, out=e_wrong), out=e_wrong)
        e_wrong += 1
        np.reciprocal(e_wrong, out=e_wrong)
        at, sums = row_sums(np.concatenate([want, noise]), np.concatenate([e_right[:, None] * x, e_wrong.T @ x]))
        gb = np.bincount(want, e_right, len(b)) + np.bincount(noise, e_wrong.sum(0), len(b))
        return e_right[:, None] * qw + e_wrong @ qn, sums, at, gb.astype("f4")

    @staticmethod
    def move(value: np.ndarray, sq: np.ndarray, grad: np.ndarray, at=...) -> None:
        new = sq[at] + grad * grad
        sq[at] = new
        value[at] -= RATE * grad / np.sqrt(new)

    def step(self, want: np.ndarray, ctx: np.ndarray, more: np.ndarray) -> None:
        """One step for the classes and the contexts; more: other gradients by what the contexts expect."""
        m, n = self.m, len(want)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(m.b) - 1)
        dx, gq, at, gb = self.contrast(m.expected(ctx), want, noise, m.q, m.b, self.log_noise)
        self.move(m.q, self.sq[1], gq / n, at)
        self.move(m.b, self.sq[2], gb / n)
        dx += more
        at, grad = row_sums(ctx.T.ravel(), np.concatenate([dx * c for c in m.c]))
        gc = np.stack([np.einsum("ij,ij->j", dx, m.r.take(ctx[:, j], axis=0)) for j in range(CONTEXT)])
        self.move(m.r, self.r_sq, grad / n, at)
        self.move(m.c, self.sq[0], gc / n)

    def step_words(self, seq: np.ndarray, ctx: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Steps for each group's words; the gradients by what the contexts expect."""
        m, dx = self.m, np.zeros((len(seq), WIDTH), "f4")
        for k, some in self.counts.grouped(seq):
            lo, hi = self.counts.starts[k], self.counts.starts[k + 1]
            a, b = self.word_cumulated[[lo, hi]]
            x = m.expected(ctx[some])
            for i in range(0, len(some), WORD_BATCH):
                part = some[i : i + WORD_BATCH]
                noise = np.clip(np.searchsorted(self.word_cumulated[lo : hi + 1], a + self.rng.random(NOISE) * (b - a), side="right") - 1, 0, hi - lo - 1)
                dx[part], gq, at, gb = self.contrast(x[i : i + WORD_BATCH], slot[part] - lo, noise, m.wq[lo:hi], m.wb[lo:hi], self.word_noise[lo:hi])
                self.move(m.wq[lo:hi], self.wq_sq[lo:hi], gq / len(part), at)
                self.move(m.wb[lo:hi], self.wb_sq[lo:hi], gb / len(part))
        return dx

    def learn(self, seq: np.ndarray, before: np.ndarray, slot: np.ndarray) -> None:
        more = self.step_words(seq, before, slot)
        for i in range(0, len(seq), BATCH):
            self.step(seq[i : i + BATCH], before[i : i + BATCH], more[i : i + BATCH])


def train_round(texts: DataFrame, counts: Counts, start: np.ndarray, seed: int) -> np.ndarray:
    """Averages of what the workers (partitions of texts) made of start, weighted by the tokens behind each row."""
    words, classes = len(counts.hashes), len(counts.class_counts)
    contexts_n = words + ENDINGS + 1
    blocks, sizes = -(-len(start) // BLOCK), np.diff(counts.starts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each block of rows those that were learned from: their places, and values times weight, and weight.
        trainer, group, contexts = Trainer(Model.start(counts), counts, seed, start), np.zeros(classes, np.int64), np.zeros(contexts_n, np.int64)
        for b in slices(batches, "text"):
            t = Texts(b.column(0))
            seq, before, _, slot = counts.sequence(t, *counts.look(t))
            group += np.bincount(seq, minlength=classes)
            contexts += np.bincount(before[:, 0], minlength=contexts_n)
            trainer.learn(seq, before, slot)
        if group.any():
            weight = np.concatenate([contexts, np.full(CONTEXT + classes, group.sum()), np.repeat(group, sizes)]).astype("f8")
            seen = np.flatnonzero(weight)
            rows = np.column_stack([trainer.rows()[seen] * weight[seen, None], weight[seen]]).astype("f4")
            cuts = np.searchsorted(seen, np.arange(blocks + 1) * BLOCK)
            some = np.flatnonzero(np.diff(cuts))
            parts = [(seen[a:z] % BLOCK).astype("u2").tobytes() + rows[a:z].tobytes() for a, z in zip(cuts[some], cuts[some + 1], strict=True)]
            worker = np.full(len(some), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(worker), pa.array(parts, pa.binary())], ["block", "worker", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                n = len(v) // (2 + 4 * (start.shape[1] + 1))
                sums.setdefault(k, np.zeros((BLOCK, start.shape[1] + 1)))[np.frombuffer(v, "u2", n)] += np.frombuffer(v, "f4", offset=2 * n).reshape(n, -1)
        yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "v"])

    sent = texts.mapInArrow(work, "block int, worker int, v binary").repartition("block").sortWithinPartitions("block", "worker")
    with exchanges_deleted(texts.sparkSession):
        got = sent.mapInArrow(add, "block int, v binary").toArrow()  # one row per block
    values = start.copy()
    for k, v in zip(got.column("block").to_pylist(), got.column("v").to_pylist(), strict=True):
        v = np.frombuffer(v, "f8").reshape(BLOCK, -1)
        seen = np.flatnonzero(v[:, -1])
        values[k * BLOCK + seen] = v[seen, :-1] / v[seen, -1:]
    return values


def learn(training: DataFrame, rounds: int = ROUNDS, worker_bytes: int = WORKER_BYTES) -> tuple[Counts, Model, DataFrame]:
    """Exact counts over training(doc_id, text), the parameters after all rounds, and the table of word counts."""
    size, docs = training.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    # Each worker sends all parameters that it changed: their number is what bounds that traffic.
    workers = min(MOST_WORKERS, max(1, -(-size // (rounds * worker_bytes))))
    counts, words = vocabulary(training, docs)
    values = Trainer(Model.start(counts), counts).rows()
    for r in range(rounds):
        values = train_round(dealt(training, workers, r, rounds), counts, values, SEED + r)
    return counts, Model.start(counts).filled(values[:, : WIDTH + 1]), words


# --------------------------------------------------------------------- scoring
def lm_scores(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score: all documents, learning from those with train."""
    texts = docs.select("doc_id", F.coalesce(train, F.lit(True)).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    counts, model, words = learn(texts.filter("train").select("doc_id", "text"))
    logs, other_logs = np.log10(counts.counts + 1.0), np.log10(counts.other_counts + 1.0)
    end_log = float(np.log10(counts.docs + 1.0))
    # A word without a vector has its count's share of its ending's words, all unknown ones together one more.
    rare_class = counts.class_counts[counts.top : counts.end]
    shares = np.log10(rare_class + counts.distinct + 1.0)
    tokens, distinct = int(counts.class_counts.sum()), int(counts.distinct.sum()) + len(counts.hashes) + (counts.docs > 0)
    rare_type = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            t = Texts(b.column(2))
            at, classes = counts.look(t)
            seq, before, row, slot = counts.sequence(t, at, classes)
            lm = np.bincount(row, model.log_word_probabilities(counts, seq, before, slot), t.n) / LN10
            rest = np.flatnonzero(at < 0)
            known, value = at >= 0, np.zeros(len(at))
            value[known] = logs[at[known]]
            other = found(counts.others, t.h[rest])
            here = rest[other >= 0]
            known[here], value[here] = True, other_logs[other[other >= 0]]
            lm += np.bincount(t.rows[rest], value[rest] - shares[t.endings[rest]], t.n)
            # Words whose counts aren't here: each document's distinct ones, with their number.
            rare = np.flatnonzero(~known)
            order = rare[np.lexsort((t.h[rare], t.rows[rare]))]
            h, rows = t.h[order], t.rows[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(h))).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(h[new].view(np.int64)), pa.array(n)], ["h", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[new], np.arange(t.n + 1)), pa.int32()), items)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(t.bounds) + 1), pa.array(np.bincount(t.rows, known, t.n).astype(np.int64)), pa.array(np.bincount(t.rows, value, t.n)), pa.array(lm), lists.cast(rare_type)],
                ["doc_id", "train", "n_tokens", "known", "logs", "lm", "rare"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(work, f"doc_id {kind}, train boolean, n_tokens long, known long, logs double, lm double, rare array<struct<h: long, n: int>>")
    scored = table(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("row", F.inline("rare")).join(words.select("h", F.col("n").alias("c")), "h")
    by_doc = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("rare_logs"), F.sum("n").alias("rare_known"))
    out = scored.drop("rare").join(by_doc, "row", "left").withColumn("rare_logs", F.coalesce("rare_logs", F.lit(0.0)))
    return out.select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(counts.docs > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(tokens + distinct + 1)))).alias("base_score"),
        (F.col("lm") + F.col("rare_logs")).alias("score"),
    )


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"), in_training(F.col("doc_id"))).withColumn("held_out", ~F.col("train")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
