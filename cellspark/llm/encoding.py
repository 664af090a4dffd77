"""Token counts and token ids of whole texts, batch by batch, each piece encoded once.

A text is split at the ends of its words, where no pre-token of the supported
tokenizers crosses: pieces are a run of white space and the word after it (for
ids), or the word alone (for counts, where the tokenizer drops white space).
The pieces of a batch are found by a 64-bit hash and compared byte by byte with
those of this worker's table; new ones go to the library in one batch call.
For ids, a word with white space beyond ASCII or with what may be a special
token's string forms one piece with the words beside it.

* null or empty text: no tokens. Very long texts: as many pieces; a task looks
  at bounded slices of its rows, cut by bytes.
* Repeated rows and ties: each row has its own result. Null doc_id: kept.
* An empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK, Words, flat, read, run_hashes, slices, within

#: A worker forgets its pieces beyond this number, and beyond so many bytes.
MOST_PIECES, MOST_BYTES = 1_500_000, 64 << 20
LIMIT = 2048


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def odd_places(data: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Where white space beyond ASCII's may be, or the first two bytes of a special token."""
    a, b = data[:-1], data[1:]
    hit = (a >= 0x1C) & (a <= 0x1F)
    hit |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE3) & (b == 0x80)) | ((a == 0xE2) & (b == 0x81))
    for m in marks:
        hit |= (a == m[0]) & (b == m[1]) if len(m) > 1 else a == m[0]
    wide = np.flatnonzero((a == 0xE2) & (b == 0x80))
    wide = wide[wide + 2 < len(data)]
    third = data[wide + 2]
    hit[wide[(third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)]] = True
    at = np.flatnonzero(hit)
    return np.append(at, len(data) - 1) if len(data) and (0x1C <= data[-1] <= 0x1F or any(len(m) == 1 and m[0] == data[-1] for m in marks)) else at


def same_bytes(a: np.ndarray, a_starts: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_sizes: np.ndarray) -> bool:
    """Whether runs of bytes of a and of b are the same, CHUNK bytes at a time."""
    if not np.array_equal(a_sizes, b_sizes):
        return False
    ends, at = np.cumsum(a_sizes), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        if to == at + 1:
            x, y, n = int(a_starts[at]), int(b_starts[at]), int(a_sizes[at])
            same = np.array_equal(a[x : x + n], b[y : y + n])
        else:
            same = np.array_equal(a[within(a_starts[at:to], a_sizes[at:to])], b[within(b_starts[at:to], b_sizes[at:to])])
        if not same:
            return False
        at = to
    return True


class Pieces:
    """A worker's table from pieces of text to their token ids, or only to their number of tokens.

    The table is searched by 64-bit keys, and each piece found is compared with
    the table's one byte by byte.
    """

    def __init__(self, path: str, ids: bool, plain: bool = False):
        """plain: strings of special tokens within texts are text like any other."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.ids = Tokenizer.from_file(path), ids
        self.tok.encode_special_tokens = plain
        added = [] if plain else json.loads(Path(path).read_text())["added_tokens"]
        self.marks = list({x["content"].encode()[:2] for x in added})
        #: Whether special tokens lie within words and take no white space beside them.
        self.apart = not any(x["lstrip"] or x["rstrip"] or re.search(r"\s", x["content"]) for x in added)
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.keys, self.lengths, self.froms, self.flat, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(1 << 16, self.kind), 0
        self.sizes, self.begins, self.raw, self.filled = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, np.uint8), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray | None]:
        """Each text's number of tokens, and all their ids if this table holds ids."""
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        if not self.ids:
            return np.fromiter(map(len, found), np.int32, len(found)), None
        each = [x.ids for x in found]
        lengths = np.fromiter(map(len, each), np.int32, len(each))
        return lengths, np.fromiter((i for x in each for i in x), self.kind, int(lengths.sum()))

    def learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        lengths, ids = self.encode([x.decode() for x in texts])
        froms = np.zeros(len(texts), np.int64)
        if self.ids:
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(ids)] = ids
            froms = self.used + np.cumsum(lengths) - lengths
            self.used += len(ids)
        raw, sizes = np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))
        while self.filled + len(raw) > len(self.raw):
            self.raw = np.concatenate([self.raw, np.zeros_like(self.raw)])
        self.raw[self.filled : self.filled + len(raw)] = raw
        begins = self.filled + np.cumsum(sizes) - sizes
        self.filled += len(raw)
        to = np.searchsorted(self.keys, keys)
        self.keys, self.lengths, self.froms, self.sizes, self.begins = (np.insert(x, to, y) for x, y in ((self.keys, keys), (self.lengths, lengths), (self.froms, froms), (self.sizes, sizes), (self.begins, begins)))

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place in the table, which gets the new ones, of each piece's key."""
        each, first, which = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(each) > MOST_PIECES or self.filled > MOST_BYTES:
            self.forget()
        at = np.minimum(np.searchsorted(self.keys, each), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != each) if len(self.keys) else np.arange(len(each))
        if len(new):
            raw = data.tobytes()
            self.learn(each[new], [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        return np.searchsorted(self.keys, each)[which]

    def encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Each piece's number of tokens, and their ids, one piece after the other."""
        at, sizes = self.places(data, starts, ends), ends - starts
        if not same_bytes(self.raw, self.begins[at], self.sizes[at], data, starts, sizes):
            raw = data.tobytes()  # two pieces with one key: this slice does without the table
            return self.encode([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        n = self.lengths[at]
        return n, self.flat[within(self.froms[at], n.astype(np.int64))] if self.ids else None

    def whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that can't be cut, as the tokenizer has special tokens that reach beyond a word."""
        rows = np.zeros(len(offsets) - 1, bool)
        if not self.apart:
            rows[np.searchsorted(offsets, odd_places(data, self.marks), side="right") - 1] = True
        return rows

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row, for tokenizers that drop white space: no token crosses it, of any kind."""
        w = Words(data, offsets)
        sums = np.zeros(len(w.starts) + 1, np.int64)
        if len(w.starts):
            np.cumsum(self.encoded(data, w.starts, w.ends)[0], out=sums[1:])
        out = sums[w.bounds[1:]] - sums[w.bounds[:-1]]
        for i in np.flatnonzero(self.whole(data, offsets)):
            out[i] = self.encode([data[offsets[i] : offsets[i + 1]].tobytes().decode()])[0][0]
        return out

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of pieces that cover all rows: white space and the word behind it, and what follows a row's last word.

        Words with white space beyond ASCII or a special token's beginning form
        one piece with their neighbours: a cut lies between two plain words.
        """
        w = Words(data, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), w.counts())
        starts = np.concatenate([[0], w.ends[:-1]]) if len(w.ends) else w.starts
        odd = np.zeros(len(row), bool)
        if len(row):
            head = np.concatenate([[True], row[1:] != row[:-1]])
            starts = np.where(head, offsets[row], starts)
            odd[np.maximum(np.searchsorted(w.starts, odd_places(data, self.marks), side="right") - 1, 0)] = True
            near = odd.copy()
            near[1:] |= odd[:-1] & ~head[1:]
            near[:-1] |= odd[1:] & ~head[1:]
            odd = near
        tails, tail_odd = offsets[:-1].copy(), np.zeros(len(offsets) - 1, bool)
        full = w.counts() > 0
        tails[full], tail_odd[full] = w.ends[w.bounds[1:][full] - 1], odd[w.bounds[1:][full] - 1]
        extra = np.flatnonzero(tails < offsets[1:])
        all_s, all_e = np.concatenate([starts, tails[extra]]), np.concatenate([w.ends, offsets[1:][extra]])
        all_row, all_odd = np.concatenate([row, extra]), np.concatenate([odd, tail_odd[extra]])
        order = np.argsort(all_s, kind="stable")
        all_s, all_e, all_row, all_odd = all_s[order], all_e[order], all_row[order], all_odd[order]
        new = np.ones(len(all_s), bool)
        new[1:] = ~(all_odd[1:] & all_odd[:-1] & (all_row[1:] == all_row[:-1]))
        first = np.flatnonzero(new)
        return all_s[first], all_e[np.append(first[1:], len(all_s)) - 1] if len(first) else all_e

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Token ids of each row."""
        starts, ends = self.cuts(data, offsets)
        ids, bounds = np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        if len(starts):
            n, ids = self.encoded(data, starts, ends)
            bounds = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offsets)]
        whole = self.whole(data, offsets)
        for i in range(len(offsets) - 1):
            yield (self.encode([data[offsets[i] : offsets[i + 1]].tobytes().decode()])[1] if whole[i] else ids[bounds[i] : bounds[i + 1]]).astype(np.uint32)


_tables: dict[tuple[str, bool], Pieces] = {}


def pieces(path: str, ids: bool) -> Pieces:
    """This worker's table; tasks that it runs later find it filled."""
    if (path, ids) not in _tables:
        _tables[path, ids] = Pieces(path, ids)
    return _tables[path, ids]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for a tokenizer file whose pre-tokenizer drops white space."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path, False)
        for b in slices(batches, "text"):
            data, offsets = flat(b.column(1))
            n = table.counts(data, offsets)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
