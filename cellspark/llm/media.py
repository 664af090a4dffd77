"""Media columns: PNG in binary columns, and low-frequency cosine-transform hashes of what is read back.

A PNG holds 8-bit grey samples. Writing chooses one of the five filters for each
row (the least sum of absolute differences) and deflates the filtered rows into
IDAT chunks with checksums; reading tests the signature, every chunk's CRC and
the stream's Adler-32, and undoes the filters in numpy, along the diagonals of
all images of a slice at once. The hash has one bit for
each of the 8 by 8 lowest frequencies: whether it lies above the median of
those without the constant one.

* null or empty text: one block of padding. Very long texts: a taller image.
* Repeated rows and ties: equal texts give equal media and features.
* An empty table: no rows. Null doc_id: kept. Extra columns are ignored.
* A damaged image raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import flat, read, slices, table, within

WIDTH, BLOCK, LEVEL = 192, 576, 3
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def predictions(samples: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """What each of the five row filters expects; first: rows that have none above them."""
    left, up, corner = np.zeros_like(samples), np.zeros_like(samples), np.zeros_like(samples)
    left[:, 1:], up[1:], corner[1:, 1:] = samples[:, :-1], samples[:-1], samples[:-1, :-1]
    up[first] = corner[first] = 0
    yield from (np.zeros_like(samples), left, up, ((left.astype(np.uint16) + up) >> 1).astype(np.uint8), paeth(left, up, corner))


def filtered(samples: np.ndarray, first: np.ndarray, kinds: np.ndarray | None = None) -> np.ndarray:
    """Rows of a filter type and filtered bytes; without kinds, each row's with the least sum of absolute differences, of equals the lowest."""
    h, w = samples.shape
    out, least = np.zeros((h, w + 1), np.uint8), np.full(h, np.iinfo(np.int64).max)
    for kind, guess in enumerate(predictions(samples, first)):
        rows = samples - guess
        cost = np.minimum(rows, -rows).sum(1, dtype=np.int64) if kinds is None else np.where(kinds == kind, -1, least)
        better = np.flatnonzero(cost < least)
        least[better], out[better, 0], out[better, 1:] = cost[better], kind, rows[better]
    return out


def packed(rows: np.ndarray, level: int = LEVEL, idat: int = 1 << 16) -> bytes:
    """Filtered rows as a grey 8-bit PNG."""
    z = zlib.compress(rows.tobytes(), level)
    parts = [z[i : i + idat] for i in range(0, len(z), idat)]
    return b"".join([SIGNATURE, chunk(b"IHDR", struct.pack(">IIBBBBB", rows.shape[1] - 1, len(rows), 8, 0, 0, 0, 0)), *(chunk(b"IDAT", x) for x in parts), chunk(b"IEND", b"")])


def png(samples: np.ndarray, filters: int | np.ndarray | None = None, level: int = LEVEL, idat: int = 1 << 16) -> bytes:
    """Grey 8-bit samples (rows, columns) as PNG; filters: a PNG filter type, or one per row, or chosen for each row."""
    first = np.arange(len(samples)) == 0
    return packed(filtered(samples, first, None if filters is None else np.broadcast_to(np.asarray(filters), (len(samples),))), level, idat)


def paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The one of left, up and corner that is nearest to left + up - corner; ties in this order."""
    x, y, z = a.astype(np.int16), b.astype(np.int16), c.astype(np.int16)
    pa_, pb, pc_ = abs(y - z), abs(x - z), abs(x + y - 2 * z)
    return np.where((pa_ <= pb) & (pa_ <= pc_), a, np.where(pb <= pc_, b, c))


def unfilter(rows: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Samples from rows of a filter type and filtered bytes, of any number of images of one width below each other.

    Rows of types 0 and 1 need no other row. Each row below such a one, or at
    the top of an image, begins one step after the row above it, so that a step
    computes one sample of every row that is under way: a diagonal of each image.
    """
    h, w = len(rows), rows.shape[1] - 1
    kinds = rows[:, 0]
    if h and kinds.max() > 4:
        raise ValueError("unknown filter type")
    first = np.arange(h) == 0 if first is None else first
    out = np.zeros((h + 1, w + 1), np.uint8)  # a row and a column of zeros before the samples
    out[1:, 1:] = rows[:, 1:]
    left = np.flatnonzero(kinds == 1)
    out[left + 1, 1:] = np.cumsum(rows[left, 1:], axis=1, dtype=np.uint8)
    # The steps that a row waits: its distance from the last row that needs none above it.
    starts = (kinds < 2) | first
    at = np.arange(h)
    begun = np.maximum.accumulate(np.where(starts, at, 0))
    wait = at - begun
    need = np.flatnonzero(kinds >= 2)
    need = need[np.argsort(wait[need], kind="stable")]
    wait = wait[need]
    flat_out, kind = out.ravel(), kinds[need]
    here = (need + 1) * (w + 1) + 1 - wait
    above = np.where(first[need], 0, need) * (w + 1) + 1 - wait
    is_up, is_mean = kind == 2, kind == 3
    for t in range(int(wait[-1]) + w if len(need) else 0):
        lo, hi = np.searchsorted(wait, [t - w, t], side="right")
        i, j = here[lo:hi] + t, above[lo:hi] + t
        a, b, c = flat_out[i - 1].astype(np.int16), flat_out[j].astype(np.int16), flat_out[j - 1].astype(np.int16)
        pa_, pb = b - c, a - c
        pc_ = np.abs(pa_ + pb)
        np.abs(pa_, out=pa_)
        np.abs(pb, out=pb)
        guess = np.where((pa_ <= pb) & (pa_ <= pc_), a, np.where(pb <= pc_, b, c))
        guess = np.where(is_up[lo:hi], b, np.where(is_mean[lo:hi], (a + b) >> 1, guess))
        flat_out[i] += guess.astype(np.uint8)
    return out[1:, 1:]


def unpng(data: bytes) -> np.ndarray:
    """The samples of a grey 8-bit PNG; ValueError for anything damaged or of another kind."""
    return unfilter(unpacked(data))


def unpacked(data: bytes) -> np.ndarray:
    """The filtered rows of a grey 8-bit PNG, all its checksums tested."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, parts, shape, ended = 8, [], None, False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("cut off in a chunk")
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        body, crc = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or struct.unpack(">I", crc)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            w, h, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("not a grey 8-bit image without interlacing")
            shape = (h, w + 1)
        elif kind == b"IDAT":
            parts.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if shape is None or not ended:
        raise ValueError("no header or no end")
    try:
        raw = zlib.decompress(b"".join(parts))
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) != shape[0] * shape[1]:
        raise ValueError("wrong number of samples")
    return np.frombuffer(raw, np.uint8).reshape(shape)


def all_samples(images: list[np.ndarray]) -> list[np.ndarray]:
    """The samples of each image from its filtered rows; images of one width are unfiltered together."""
    out: list[np.ndarray] = [None] * len(images)
    widths = np.array([x.shape[1] for x in images])
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        cuts = np.cumsum([0, *(len(images[i]) for i in own)])
        first = np.zeros(cuts[-1], bool)
        first[cuts[:-1][np.diff(cuts) > 0]] = True
        samples = unfilter(np.concatenate([images[i] for i in own]), first)
        for i, lo, hi in zip(own, cuts[:-1], cuts[1:], strict=True):
            out[i] = samples[lo:hi]
    return out


@lru_cache(512)
def cosines(n: int, low: int = 8) -> np.ndarray:
    return np.cos(np.pi / n * (np.arange(n) + 0.5)[None] * np.arange(low)[:, None])


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits in hex: which of the 8 x 8 lowest frequencies lie above their median."""
    h, w = samples.shape
    c = (cosines(h) @ samples.astype(np.float64) @ cosines(w).T / (h * w)).round(9).ravel()
    return np.packbits(c > np.median(c[1:])).tobytes().hex()


def encode_media(docs: DataFrame, width: int = WIDTH, block: int = BLOCK, level: int = LEVEL) -> DataFrame:
    """doc_id, n_bytes, media: the text's UTF-8 bytes, padded with 255 to blocks, as a PNG."""
    if block % width:
        raise ValueError("a block must be whole rows")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            data, offsets = flat(b.column(1))
            ends = np.cumsum(np.maximum(block, -(-np.diff(offsets) // block) * block))
            payload = np.full(ends[-1], 255, np.uint8)
            payload[within(np.concatenate([[0], ends[:-1]]), np.diff(offsets))] = data
            cuts = np.concatenate([[0], ends]) // width
            first = np.zeros(cuts[-1], bool)
            first[cuts[:-1]] = True
            rows = filtered(payload.reshape(-1, width), first)
            media = [packed(rows[lo:hi], level) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(put, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """Decode the media column: payload sizes and checksums, and the hash."""
    kinds = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "media"):
            rows, media = [], b.column(2).to_pylist()
            for x, samples in zip(media, all_samples([unpacked(x) for x in media]), strict=True):
                raw = samples.tobytes()
                rows.append((len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(x), hashlib.sha256(x).hexdigest(), cosine_hash(samples)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n_bytes", *(n for n, _ in kinds)])

    doc_id = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(get, f"doc_id {doc_id}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(table(encode_media(read(spark, sf_dir, "documents")), "media"))
