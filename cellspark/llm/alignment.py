"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often ids meet in a corpus.

Byte offsets where tokens of both tokenizers end cut a text into groups. Every A
token of a group is linked with every B token of it; an id pair's count is
the number of documents that hold it linked.

Texts are cut into pieces before a blank that follows a word, where tokens of
either tokenizer begin: groups lie within pieces. A worker aligns each distinct
piece once, many at a time (cumulative sums of byte lengths, their common values,
labels by binary search, links by repetition), finds it again by a 64-bit hash
and compares it byte by byte.

Each slice of texts becomes one row, a block: its documents' distinct links as
places in the block's list of distinct pairs. Pairs are summed up per block, then
by pair and salt, then by pair; a block's pairs meet their counts by
a salted join, and the counts meet the block's documents again. So the exchanges
carry a pair once per block, not once per document or link.

* null or empty text, and texts whose joined A or B bytes differ from blank +
  text: no tokens; all counts are 0 and the groups empty. Very long texts: cut into
  parts of PART bytes between two plain words, aligned one after the other.
* Repeated rows and ties: each row is a document of its own and has its own
  result. Ties for an A id's highest count are all best. Null doc_id: kept.
* An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BATCH_BYTES, flat, read, run_hashes, setting, slices, table, within
from .encoding import Pieces, same_bytes, tokenizer_path

#: Bytes of text in a block.
SLICE = 2_000_000
#: Bytes of text that are aligned together, and what a long text is cut into; new pieces that the tokenizers get in one call.
PART, BATCH = 256_000, 4_096
#: Blocks in a row group: Spark's reader decodes a whole one at once, if it has fewer than some thousand rows.
GROUP = 8
#: A worker forgets its pieces beyond so many, and beyond so many bytes of groups and links.
MOST_PIECES, MOST_BYTES = 400_000, 64 << 20
#: Copies of a pair's row in exchanges.
SALT = 8
#: Ids of B below 2**BITS; a pair is the A id, shifted, and the B id.
BITS = 16
#: Pairs are below 2**ROW; with a row's number before them, links of many rows are counted in one array.
ROW = 36


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others for 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of each token id, as one array with begins and sizes."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.raw[within(self.begins[ids], self.sizes[ids])]


class Digits:
    """Decimal numbers below n, six bytes each, to be written out many at a time."""

    def __init__(self, n: int):
        shown = [str(i).encode() for i in range(n)]
        self.sizes = np.fromiter(map(len, shown), np.int64, n)
        self.width = int(self.sizes.max(initial=1)) + 1
        self.table = np.frombuffer(b"".join(x.ljust(self.width) for x in shown), np.uint8).reshape(-1, self.width)

    def written(self, numbers: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers' digits, each followed by its byte of `behind`, and how many bytes each takes."""
        sizes, out = self.sizes[numbers], self.table[numbers]
        out[np.arange(len(numbers)), sizes] = behind
        return out[np.arange(self.width) <= sizes[:, None]], sizes + 1


class Grown:
    """An array to which rows are appended, with room for half as many more when it has to move."""

    def __init__(self, kind: type, *width: int):
        self.room, self.used = np.zeros((1 << 12, *width), kind), 0

    def __len__(self) -> int:
        return self.used

    def add(self, rows: np.ndarray) -> None:
        need = self.used + len(rows)
        if need > len(self.room):
            room = np.empty((need + need // 2, *self.room.shape[1:]), self.room.dtype)
            room[: self.used] = self.room[: self.used]
            self.room = room
        self.room[self.used : need] = rows
        self.used = need

    def nbytes(self) -> int:
        return self.used * self.room[:1].nbytes


class Pool:
    """Runs of values of one kind, appended and gathered many at a time."""

    def __init__(self, kind: type):
        self.values, self.begins, self.sizes = Grown(kind), Grown(np.int64), Grown(np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.begins.add(len(self.values) + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.values.add(values)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes.room[at]
        return self.values.room[within(self.begins.room[at], sizes)], sizes

    def nbytes(self) -> int:
        return self.values.nbytes()


class Aligner:
    """A worker's table from pieces of text to their tokens' groups and links."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        self.a = Pieces(path_a, True, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_level()
        tokens = {i: bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode() for s, i in self.a.tok.get_vocab().items()}
        self.bytes_a = Vocabulary([tokens.get(i, b"") for i in range(max(tokens) + 1)])
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        if len(pieces) > 1 << BITS or len(tokens) > 1 << ROW - BITS or any(re.search("[^▁]▁", p) for p, _ in pieces):
            raise ValueError("B has pieces that reach beyond a word, or too many")
        self.bytes_b = Vocabulary([bytes([int(p[1:-1], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces])
        self.blank = self.b.piece_to_id("▁")
        self.digits = Digits(max(len(self.bytes_a.sizes), len(pieces)))
        self.forget()

    def forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.raw, self.text, self.links = Pool(np.uint8), Pool(np.uint8), Pool(np.int64)
        #: n_a, n_b, n_groups and whether all bytes are covered, of each piece.
        self.numbers = Grown(np.int64, 4)

    def encoded(self, pieces: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all pieces and how many each has, by A and by B (which adds the blank that a piece begins with)."""
        ids, sizes = ([], []), ([], [])
        for i in range(0, len(pieces), BATCH):
            some = pieces[i : i + BATCH]
            a = [x.ids for x in self.a.tok.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)]
            b = self.b.encode([p[1:].decode() for p in some], num_threads=1)
            b = [x if len(p) > 1 else [self.blank] for p, x in zip(some, b, strict=True)]
            for k, found in enumerate((a, b)):
                n = np.fromiter(map(len, found), np.int64, len(found))
                ids[k].append(np.fromiter((i for x in found for i in x), np.int64, int(n.sum())))
                sizes[k].append(n)
        return [np.concatenate(x) for x in ids], [np.concatenate(x) for x in sizes]

    def learn(self, pieces: list[bytes]) -> None:
        """Append pieces with their groups and links."""
        (a, b), (n_a, n_b) = self.encoded(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        self.raw.add(raw, sizes)
        if np.array_equal(self.bytes_a.joined(a), raw) and np.array_equal(self.bytes_b.joined(b), raw):
            whole = np.ones(len(pieces), bool)
        else:
            # Some piece is not what its tokens spell: it has none.
            cut = lambda x, n: np.split(x, np.cumsum(n)[:-1])
            same = lambda v, ids, p: v.joined(ids).tobytes() == p
            whole = np.array([same(self.bytes_a, x, p) and same(self.bytes_b, y, p) for x, y, p in zip(cut(a, n_a), cut(b, n_b), pieces, strict=True)])
            a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
            n_a, n_b, sizes = n_a * whole, n_b * whole, sizes * whole
        ends_a, ends_b = np.cumsum(self.bytes_a.sizes[a]), np.cumsum(self.bytes_b.sizes[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        groups = np.diff(np.searchsorted(common, np.concatenate([[0], np.cumsum(sizes)]), side="right"))
        # Each A token is repeated for the B tokens of its group.
        first_b = np.cumsum(in_b) - in_b
        times = in_b[group_a]
        self.links.add(np.repeat(a, times) << BITS | b[within(first_b[group_a], times)], self.per_piece(in_a * in_b, groups))
        # A's tokens of a group, then B's, as text.
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True)[: len(a)], np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + first_b[group_a]] = np.arange(len(a))
        order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = len(a) + np.arange(len(b))
        behind = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order]
        text, each = self.digits.written(np.concatenate([a, b])[order], behind)
        self.text.add(text, self.per_piece(each, n_a + n_b))
        self.numbers.add(np.stack([n_a, n_b, groups, whole.astype(np.int64)], axis=1))

    @staticmethod
    def per_piece(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums of runs of values."""
        sums = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each piece's place in the table, which learns the new ones."""
        each, first, which = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(each) > MOST_PIECES or sum(p.nbytes() for p in (self.raw, self.text, self.links)) > MOST_BYTES:
            self.forget()
        at = np.minimum(np.searchsorted(self.keys, each), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != each) if len(self.keys) else np.arange(len(each))
        cut = lambda i: [data[x:y].tobytes() for x, y in zip(starts[i].tolist(), ends[i].tolist(), strict=True)]
        if len(new):
            places = len(self.numbers) + np.arange(len(new))
            self.learn(cut(first[new]))
            to = np.searchsorted(self.keys, each[new])
            self.keys, self.places = np.insert(self.keys, to, each[new]), np.insert(self.places, to, places)
        at = self.places[np.searchsorted(self.keys, each)][which]
        if not same_bytes(self.raw.values.room, self.raw.begins.room[at], self.raw.sizes.room[at], data, starts, ends - starts):
            self.forget()  # two pieces with one key: these are learnt one by one, and forgotten by the next part
            self.learn(cut(np.arange(len(starts))))
            at = np.arange(len(starts))
        return at

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of rows that begin with a blank: cut before a blank behind a word."""
        starts, ends = self.a.cuts(data, offsets)
        keep = data[starts] == 0x20
        return starts[keep], ends[np.append(np.flatnonzero(keep)[1:], len(ends)) - 1] if keep.any() else ends[:0]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's table."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def parts(data: np.ndarray, offsets: np.ndarray, most: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """rows, data, offsets: texts of `most` bytes together, with a blank before each; one of over twice as many in parts, cut before a blank between two plain words."""
    rows, at = np.flatnonzero(np.diff(offsets)), 0
    begins, ends = offsets[:-1][rows], offsets[1:][rows]
    while at < len(rows):
        lo = begins[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + most, side="right")))
        some, part, starts = rows[at:to], data[lo : ends[to - 1]], begins[at:to] - lo
        if len(part) > 2 * most:
            yield from long_parts(some, part, most)
        else:
            yield some, np.insert(part, starts, 0x20), np.append(starts, len(part)) + np.arange(len(some) + 1)
        at = to


def long_parts(row: np.ndarray, data: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The parts of one text."""
    at, n = 0, len(data)
    while at < n:
        to, look = min(at + most, n), min(at + most, n)
        while look < n:
            near = data[look - 1 : look + 65_536]
            hit = np.flatnonzero(_PLAIN[near[:-2]] & (near[1:-1] == 0x20) & _PLAIN[near[2:]])
            to = look + int(hit[0]) if len(hit) else n
            if len(hit):
                break
            look += 65_534
        part = data[at:to]
        yield row, np.insert(part, 0, 0x20) if at == 0 else part, np.array([0, len(part) + (at == 0)])
        at = to


class Found:
    """The alignment of a slice of texts: numbers, groups (texts, or their digests) and distinct links of each, with their times."""

    def __init__(self, tables: Aligner, data: np.ndarray, offsets: np.ndarray, texts: bool):
        n = len(offsets) - 1
        self.numbers = np.zeros((n, 3), np.int64)
        whole, begun, done = np.diff(offsets) > 0, np.zeros(n, bool), [[] if texts else hashlib.sha256() for _ in range(n)]
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for rows, raw, bounds in parts(data, offsets):
            starts, ends = tables.cuts(raw, bounds)
            at = tables.find(raw, starts, ends)
            cut = np.searchsorted(starts, bounds)
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(tables.numbers.room[at], axis=0)])
            each = sums[cut[1:]] - sums[cut[:-1]]
            self.numbers[rows] += each[:, :3]
            whole[rows] &= each[:, 3] == np.diff(cut)
            text, sizes = tables.text.take(at)
            marks = np.concatenate([[0], np.cumsum(sizes)])[cut].tolist()
            for i, a, z in zip(rows.tolist(), marks[:-1], marks[1:], strict=True):
                # The mark behind a part's last group comes before the next part instead.
                run = (b";" if begun[i] else b"") + text[a : max(a, z - 1)].tobytes()
                done[i].append(run) if texts else done[i].update(run)
            begun[rows] = True
            pairs, sizes = tables.links.take(at)
            key, times = np.unique(np.repeat(np.repeat(rows, np.diff(cut)), sizes) << ROW | pairs, return_counts=True)
            if len(key):
                links.append((key, times))
            # Parts of a long text are merged when they have grown to half of what is before them.
            while len(links) > 1 and follow(*links[-2:]) and 2 * len(links[-1][0]) >= len(links[-2][0]):
                links[-2:] = [merged(links[-2:])]
        self.numbers[~whole] = 0
        keep = self.numbers[:, 0] > 0
        self.groups = ["" if not k else b"".join(x).decode() if texts else x.hexdigest() for k, x in zip(keep.tolist(), done, strict=True)]
        key, times = merged(links)
        some = whole[key >> ROW]
        key, self.times = key[some], times[some]
        self.pairs = key & (1 << ROW) - 1
        self.bounds = np.searchsorted(key >> ROW, np.arange(n + 1))


def follow(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether the row of a's last key is that of b's first."""
    return a[0][-1] >> ROW == b[0][0] >> ROW


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with their counts, as one; rows that don't lie in two parts are in order."""
    keys, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*parts, strict=True) if parts else ((), ())))
    if not any(follow(*x) for x in itertools.pairwise(parts)):
        return keys, times
    key, back = np.unique(keys, return_inverse=True)
    out = np.zeros(len(key), np.int64)
    np.add.at(out, back, times)
    return key, out


def texts_of(b: pa.RecordBatch, a: str, z: str, texts: bool) -> Found:
    return Found(aligner(a, z), *flat(b.column(1)), texts)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups as text `a1,a2|b1;a3|b2,b3`, and links: array<struct<a, b, times>>."""
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("times", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            f = texts_of(b, path_a, path_b, True)
            links = pa.StructArray.from_arrays([pa.array(f.pairs >> BITS), pa.array(f.pairs & (1 << BITS) - 1), pa.array(f.times)], ["a", "b", "times"])
            out = [b.column(0), *(pa.array(f.numbers[:, k]) for k in range(3)), pa.array(f.groups, pa.string()), pa.ListArray.from_arrays(pa.array(f.bounds, pa.int32()), links).cast(kind)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    return slim(docs).mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups string, links array<struct<a:long,b:long,times:long>>")


def slim(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per slice of texts; of each document: the counts, the digest of its groups, and its distinct links as places in `pairs`.

    held: how many of the block's documents hold each pair. Places and the links'
    times are bytes of the narrowest kind that they fit. Write it before use:
    a block's number is that of the task and of the slice in it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for i, b in enumerate(slices(batches, "text", SLICE)):
            f = texts_of(b, path_a, path_b, False)
            pairs, at, held = np.unique(f.pairs, return_inverse=True, return_counts=True)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x))
            columns = [*(f.numbers[:, k] for k in range(3)), pa.array(f.groups, pa.string()), pairs, held.astype(np.int32), f.bounds[1:].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([task + i]), one(b.column(0)), *map(one, columns), *(pa.array([narrow(x)]) for x in (at, f.times))], ["block", "doc_id", "n_a", "n_b", "n_groups", "digest", "pairs", "held", "bounds", "at", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim(docs).mapInArrow(work, f"block long, doc_id array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, digest array<string>, pairs array<long>, held array<int>, bounds array<int>, at binary, times binary")


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in one, two, four or eight bytes each."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()


def widened(raw: pa.Buffer, n: int) -> np.ndarray:
    """What narrow() made of n numbers."""
    return np.frombuffer(raw, f"u{raw.size // n}" if n else np.uint8).astype(np.int64)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n, best: in how many documents of all blocks each pair is linked, and whether no pair of its A id has more.

    A pair's rows are summed up by salt first. An A id has no more pairs than B has ids.
    """
    rows = found.select(F.pmod(F.hash("block"), F.lit(SALT)).alias("salt"), F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("salt", F.col("x.pairs").alias("pair"), F.col("x.held").cast("long").alias("n"))
    n = rows.groupBy("pair", "salt").agg(F.sum("n").alias("n")).groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(W.partitionBy(F.shiftright("pair", BITS)))
    return n.select("pair", "n", (F.col("n") == most).alias("best"))


def by_block(found: DataFrame, counts: DataFrame) -> DataFrame:
    """block, known: the counts of a block's pairs, in any order, with their places."""
    salts = F.explode(F.array(*map(F.lit, range(SALT)))).alias("salt")
    asked = found.select("block", F.pmod(F.hash("block"), F.lit(SALT)).alias("salt"), F.posexplode("pairs").alias("place", "pair"))
    met = asked.join(counts.select("*", salts), ["pair", "salt"])
    return met.groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("known"))


def scored(found: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document of all blocks."""
    (kind,) = (f.dataType.elementType.simpleString() for f in found.schema if f.name == "doc_id")
    joined = found.drop("pairs", "held").join(known, "block", "left")
    names = joined.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i] for k, name in enumerate(names)}
                get = lambda name: row[name].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                ends = get("bounds").astype(np.int64)
                at, times = (widened(row[name].as_buffer(), int(ends[-1])) for name in ("at", "times"))
                n, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if row["known"].is_valid:
                    x = row["known"].values
                    place, count, top = (x.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n", "best"))
                    n, best = np.empty(len(place), np.int64), np.empty(len(place), bool)
                    n[place], best[place] = count, top
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times, times * best[at], times * n[at])]
                each = [s[ends] - s[np.concatenate([[0], ends[:-1]])] for s in sums]
                yield pa.RecordBatch.from_arrays([*(row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups")), *map(pa.array, each), row["digest"].values], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return joined.mapInArrow(work, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # A batch makes four blocks, none of them small.
    with setting(spark, BATCH_BYTES, str(15 * SLICE // 4)):
        found = table(blocks(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")), "aligned", **{"parquet.block.row.count.limit": GROUP})
    counts = table(pair_counts(found), "pair-counts")
    return scored(found, table(by_block(found, counts), "known"))
