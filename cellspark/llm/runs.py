"""Periodic runs of words, by Crochemore's partition refinement.

Positions with equal factors of `p` words form classes. From length p to p + 1 a
class splits by the classes of its members' successors, and only positions before
members of small subclasses need to be looked at: of the parts of a split class,
the largest stays in place and all others move out, so that a position moves log n
times at most. Members of a class are linked in order of position; neighbours at
distance p are a square of period p, and since neighbours are the nearest ones, p is
its smallest period. Squares in a row are merged into runs.

A run with three periods holds more than p squares in a row, so that from p = 8
on it is enough to look at every 2**k-th position, with 2**(k + 2) <= p. All documents
of a slice are refined together; a word's class is its own in each document, and
a mark behind each document is unlike all words. Words are compared by 64-bit hashes.

* null or empty text, fewer words than a run needs: no runs; a null text collapses
  to the empty one. Very long texts: refined whole; beside the text this takes some
  150 bytes a word. Periods of up to a third of a document count, one round each.
* Ties: of runs with one exponent, the first by start, then by period, is the best.
  Repeated rows: each has its own result. Null doc_id: kept.
* An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, flat, mix, read, slices, within

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3
#: Positions up to this number are moved one by one.
FEW = 24
#: Bytes of text that are refined together: rounds are shared.
SLICE = 4_000_000
#: Words that are joined at a time.
JOINED = 1 << 17
#: Row numbers from here on make a word another one in each document.
ROW_KEYS = np.uint64(0xA0761D6478BD642F)

Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, length, period


class Partition:
    """Classes of positions whose factors of one length are equal; that length grows by refine()."""

    def __init__(self, keys: np.ndarray, most: np.ndarray):
        """keys: a number per position; most: the length from which on a position needs no refinement."""
        m = self.m = len(keys)
        order = np.argsort(keys, kind="stable").astype(np.int64)
        new = np.ones(m, bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        first = np.flatnonzero(new)
        self.of = np.empty(m, np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.sizes = np.diff(np.append(first, m))
        #: Each class's members, some of which may have left, in a stretch of `members`.
        self.members, self.used, self.lo, self.hi = order, m, first, np.append(first[1:], m)
        self.classes = len(first)
        self.next, self.prev = np.full(m + 1, m, np.int64), np.full(m + 1, m, np.int64)
        self.link(order, new)
        self.moved, self.length, self.most = np.arange(m), 1, most
        self.mark, self.step = np.zeros(m, bool), 0

    def link(self, order: np.ndarray, new: np.ndarray) -> None:
        """Chain positions in this order, with a new chain where `new` says so."""
        self.prev[order[1:]] = np.where(new[1:], self.m, order[:-1])
        self.next[order[:-1]] = np.where(new[1:], self.m, order[1:])
        if len(order):
            self.prev[order[0]] = self.next[order[-1]] = self.m

    def unlink(self, gone: np.ndarray) -> None:
        """Take positions, in order of class and position, out of their chains."""
        head = np.ones(len(gone), bool)
        head[1:] = self.next[gone[:-1]] != gone[1:]
        tail = np.append(head[1:], True)
        before, after = self.prev[gone[head]], self.next[gone[tail]]
        self.next[before], self.prev[after] = after, before  # place m is nobody's

    def grown(self, a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def rest(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of classes that are not marked, and which of the classes each is of."""
        sizes = self.hi[classes] - self.lo[classes]
        at, which = self.members[within(self.lo[classes], sizes)], np.repeat(np.arange(len(classes)), sizes)
        live = (self.of[at] == classes[which]) & ~self.mark[at]
        return at[live], which[live]

    def refine(self) -> None:
        """From equal factors of `length` words to those of one more; `moved` becomes what lies in new, small classes."""
        at = self.moved[1:] if len(self.moved) and not self.moved[0] else self.moved  # ascending
        self.length += 1
        before = at - 1
        use = (self.sizes[self.of[before]] > 1) & (self.most[before] >= self.length)
        before, at = before[use], at[use]
        if not len(before):
            self.moved = before
            return
        if len(before) <= FEW and self.refine_few(before.tolist(), at.tolist()):
            return
        # Groups: positions of one class whose successors share a class.
        key = self.of[before] << 32 | self.of[at]
        order = np.argsort(key, kind="stable")  # moved, and so before, ascends
        before, key = before[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        count, old = np.diff(np.append(first, len(key))), key[first] >> 32
        # Of each class: the sum of its groups, and the largest.
        head = np.ones(len(old), bool)
        head[1:] = old[1:] != old[:-1]
        heads, of_class = np.flatnonzero(head), np.cumsum(head) - 1
        left = self.sizes[old[heads]] - np.add.reduceat(count, heads)
        by_size = np.lexsort((count, of_class))
        largest = by_size[np.append(heads[1:], len(old)) - 1]
        stays = np.zeros(len(old), bool)
        stays[largest[count[largest] > left]] = True  # else the rest, which no group has, stays
        rest_goes = np.flatnonzero(stays[largest] & (left > 0))
        goes = np.repeat(~stays, count)
        gone, group = before[goes], (np.cumsum(~stays) - 1)[np.repeat(np.arange(len(old)), count)[goes]]
        groups = int((~stays).sum())
        if len(rest_goes):
            self.mark[before] = True
            more, which = self.rest(old[heads[rest_goes]])
            self.mark[before] = False
            gone, group = np.concatenate([gone, more]), np.concatenate([group, groups + which])
            groups += len(rest_goes)
            # What stays of these classes is written down anew, so that looking at members never costs more than moving them.
            kept = largest[rest_goes]
            sizes = count[kept]
            self.append(old[kept], before[within(first[kept], sizes)], sizes)
        if not len(gone):
            self.moved = gone
            return
        was = self.of[gone]
        self.unlink(gone[np.argsort(was << 32 | gone)])
        order = np.argsort(group << 32 | gone)
        gone, group, was = gone[order], group[order], was[order]
        new = np.ones(len(gone), bool)
        new[1:] = group[1:] != group[:-1]
        self.link(gone, new)
        first = np.flatnonzero(new)
        sizes, ids = np.diff(np.append(first, len(gone))), self.classes + np.arange(groups)
        self.sizes, self.lo, self.hi = (self.grown(a, self.classes + groups) for a in (self.sizes, self.lo, self.hi))
        np.subtract.at(self.sizes, was[first], sizes)
        self.sizes[ids] = sizes
        self.of[gone] = self.classes + group
        self.classes += groups
        self.append(ids, gone, sizes)
        self.moved = np.sort(gone)

    def refine_few(self, before: list[int], at: list[int]) -> bool:
        """The same for a few positions, one by one; False, and nothing done, if the rest of a class would have to move."""
        groups: dict[int, dict[int, list[int]]] = {}
        for i, j in zip(before, at, strict=True):
            groups.setdefault(int(self.of[i]), {}).setdefault(int(self.of[j]), []).append(i)
        going: list[tuple[int, list[int]]] = []
        for c, parts in groups.items():
            each = list(parts.values())
            left, largest = self.sizes[c] - sum(map(len, each)), max(each, key=len)
            if len(largest) > left:
                if left:
                    return False
                each.remove(largest)
            going += [(c, g) for g in each]
        n = self.classes + len(going)
        self.sizes, self.lo, self.hi = (self.grown(a, n) for a in (self.sizes, self.lo, self.hi))
        for c, g in going:
            for i in g:
                p, n = self.prev[i], self.next[i]
                self.next[p], self.prev[n] = n, p
                self.of[i] = self.classes
            for i, j in itertools.pairwise([self.m, *g, self.m]):
                self.next[i], self.prev[j] = j, i
            self.sizes[c] -= len(g)
            self.sizes[self.classes] = len(g)
            self.classes += 1
            if len(g) > 1:
                self.append(np.array([self.classes - 1]), np.array(g), np.array([len(g)]))
        self.moved = np.array(sorted(i for _, g in going for i in g), np.int64)
        return True

    def append(self, classes: np.ndarray, members: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(members) > 4 * self.m + 1024:
            self.compact()
        self.members = self.grown(self.members, self.used + len(members))
        self.members[self.used : self.used + len(members)] = members
        self.hi[classes] = self.used + np.cumsum(sizes)
        self.lo[classes] = self.hi[classes] - sizes
        self.used += len(members)

    def compact(self) -> None:
        """Write down all members anew; what is about to be moved is still where it was."""
        self.members = np.argsort(self.of, kind="stable")
        self.used = self.m
        have, first, n = np.unique(self.of[self.members], return_index=True, return_counts=True)
        self.lo[have], self.hi[have] = first, first + n

    def squares(self, step: int) -> np.ndarray:
        """Every step-th position whose next equal factor begins right behind it."""
        if step != self.step:
            self.step, self.looked = step, np.arange(0, self.m, step)
        at = self.looked[self.next[: self.m : step] - self.looked == self.length]
        return at[(self.next[at] < self.m) & (self.most[at] >= self.length)]


def merged(p: int, step: int, hits: np.ndarray, words: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int]]:
    """start, end of runs of period p, from squares at every step-th position."""
    cut = np.flatnonzero(np.diff(hits) != step) + 1
    first, last = np.append(0, cut), np.append(cut, len(hits)) - 1
    enough = last - first + 1 >= (max(least, times * p) - 2 * p + 1) // step
    for a, b in zip(hits[first[enough]].tolist(), hits[last[enough]].tolist(), strict=True):
        # Neighbouring positions that were not looked at: fewer than step on either side.
        lo, hi = max(a - step + 1, 0), min(b + p + step, len(words) - p)
        ahead = words[lo:a] != words[lo + p : a + p]
        behind = words[b + p : hi] != words[b + 2 * p : hi + p]
        start = a - int(np.argmax(ahead[::-1])) if ahead.any() else lo
        end = (b + p + int(np.argmax(behind)) if behind.any() else hi) + p
        if end - start >= max(least, times * p):
            yield start, end


def runs(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> Found:
    """All runs of at least `least` words and `times` periods (3 or more) within rows, by start, then period."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds)
    # Rows that are long enough, with a mark behind each.
    use = np.flatnonzero(sizes >= least)
    n = sizes[use]
    m = int((n + 1).sum())
    if not m:
        return (np.zeros(0, np.int64),) * 3
    begins = np.cumsum(n + 1) - (n + 1)
    row = np.repeat(np.arange(len(use)), n + 1)
    source = np.minimum(bounds[use][row] + np.arange(m) - begins[row], len(hashes) - 1)
    keys = mix(hashes[source] ^ mix(np.arange(rows, dtype=np.uint64)[use] + ROW_KEYS)[row])
    keys[begins + n] = np.arange(len(use), dtype=np.uint64)  # as good as never a word's
    part = Partition(keys, (n // times)[row])
    found, words, most = [], part.of.copy(), int(n.max()) // times
    while part.length <= most:
        p = part.length
        step = 1 if p < 8 else 1 << p.bit_length() - 3
        hits = part.squares(step)
        if len(hits):
            found += [(a, z - a, p) for a, z in merged(p, step, hits, words, least, times)]
        part.refine()
        if not len(part.moved):
            break
    out = np.array(sorted(found), np.int64).reshape(-1, 3)
    return source[out[:, 0]], out[:, 1], out[:, 2]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pick: np.ndarray) -> bytes:
    """Words joined by one blank each."""
    out = []
    for i in range(0, len(pick), JOINED):
        at = pick[i : i + JOINED]
        sizes = ends[at] - starts[at]
        run = np.full(int(sizes.sum()) + len(at), 0x20, np.uint8)
        to = np.cumsum(sizes + 1) - (sizes + 1)
        run[within(to, sizes)] = data[within(starts[at], sizes)]
        out.append(run.tobytes())
    return b"".join(out)[:-1]


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def finder(least: int, times: int) -> Batches:
    """doc_id, text -> doc_id, n_words, runs, collapsed."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            data, offsets = flat(b.column(1))
            w = Words(data, offsets)
            start, length, period = runs(w.hashes(), w.bounds, least, times)
            marks = np.zeros(len(w.starts) + 1, np.int32)
            np.add.at(marks, start + period, 1)
            np.add.at(marks, start + length, -1)
            kept = np.cumsum(marks[:-1]) == 0
            row = np.searchsorted(w.bounds, start, side="right") - 1
            texts = []
            for i in range(b.num_rows):
                x, y = w.bounds[i], w.bounds[i + 1]
                if offsets[i + 1] - offsets[i] <= 1 << 22 and kept[x:y].all():
                    texts.append(b" ".join(data[offsets[i] : offsets[i + 1]].tobytes().split()))  # the same characters separate words
                else:
                    texts.append(joined(data, w.starts, w.ends, x + np.flatnonzero(kept[x:y])))
            each = pa.StructArray.from_arrays([pa.array(start - w.bounds[row]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32()), each)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w.counts()), found, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return find


def periodic(docs: DataFrame, least: int = LEAST, times: int = TIMES, before: Batches | None = None) -> DataFrame:
    """doc_id, n_words, runs: array<struct<start, length, period>>, collapsed: the text's words with each run cut to its first period.

    before: what turns batches of all of docs' columns into (doc_id, text) within the same task.
    """
    find = finder(least, times)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs if before else docs.select("doc_id", "text")
    return chosen.mapInArrow((lambda x: find(before(x))) if before else find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, h -> doc_id, text: in rows whose h is a multiple of 10, a tail of words repeats its first p words.

    With n words and g = h // 10: each word from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    for b in slices(batches, "text"):
        h = b.column(2).to_pylist()
        chosen = [i for i, x in enumerate(h) if x is not None and x % 10 == 0]
        if chosen:
            data, offsets = flat(b.column(1))
            texts = b.column(1).to_pylist()
            for i in chosen:
                raw = data[offsets[i] : offsets[i + 1]]
                w = Words(raw, np.array([0, len(raw)]))
                n, g = len(w.starts), h[i] // 10
                if n:
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    at = np.arange(n)
                    at[a:] = a + (at[a:] - a) % p
                    texts[i] = joined(raw, w.starts, w.ends, at).decode()
            b = pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, b.schema.field("text").type), b.column(2)], b.schema.names)
        yield b.select(["doc_id", "text"])


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    found = periodic(docs, before=repeated)
    # Exponents are compared as length/period, by products.
    better = lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    shown = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), sha(shown).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
    exponent = F.expr("best.length * 1000 div best.period")
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
