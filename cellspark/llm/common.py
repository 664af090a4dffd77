"""What the text operators share: scratch tables, bounded batches of bytes, word hashes.

Everything that runs inside a task works on numpy views of Arrow buffers, so
that a text of any length costs a few array operations and no Python object
per word.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path
from threading import Lock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task looks at in one go.
SLICE_BYTES = 1_000_000

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_scratch: dict[str, list[str]] = {}
_scope = ""
_lock = Lock()
#: Of each setting that holds for a while: how many want it, and what it was before.
_settings: dict[str, tuple[int, str | None]] = {}


# --------------------------------------------------------------- scratch tables
def prepare(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies on the driver's path, too."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Where that setting is missing (tests on one machine) a folder of this
    machine is taken, and only there.
    """
    prepare(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/cellspark-scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(_scope, []).append(path)
    return path


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Scratch tables made inside belong to this name, by which they can be released."""
    global _scope
    before, _scope = _scope, name
    try:
        yield
    finally:
        _scope = before


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What runs inside finds a setting so; this may overlap in threads of a session."""
    with _lock:
        n, before = _settings.get(key, (0, None))
        if not n:
            before = spark.conf.get(key, None)
            spark.conf.set(key, value)
        _settings[key] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _settings[key]
            _settings[key] = n - 1, before
            if n == 1:
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def exchanges_deleted(spark: SparkSession) -> AbstractContextManager[None]:
    """What runs inside has its exchanges' files deleted when it ends."""
    return setting(spark, CLEAN_UP, "true")


def table(df: DataFrame, name: str, path: str | None = None, **options: int) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, outlives executors.

    Once the table is there, the exchanges behind it are needed no longer:
    Spark deletes their files at the end of this write, so that they leave room
    for the next ones. options: of the Parquet writer.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with exchanges_deleted(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, name: str = "") -> None:
    """Delete a scope's scratch tables; call it when what was built on them has been written."""
    jvm = spark._jvm
    for path in _scratch.pop(name, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def even_keys(spark: SparkSession, n: int) -> np.ndarray:
    """n numbers, the k-th of which repartition(n, number) sends to partition k."""
    found = spark.range(64 * n).select(F.col("id").cast("int").alias("key"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("part"))
    rows = found.groupBy("part").agg(F.min("key").alias("key")).collect()  # n rows
    out = np.arange(n, dtype=np.int32)
    out[[r["part"] for r in rows]] = [r["key"] for r in rows]
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------- batches of texts
def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part has `most` bytes of `column`, or a single row."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, where, data = col.buffers()
    kind = np.int64 if large else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all runs of `sizes` places from `starts` on, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


# ------------------------------------------------------------------ word hashes
#: Longer runs of bytes are hashed by BLAKE2: polynomials modulo 2**64 have known collisions from about 1,000 terms on.
LONG_RUN, CHUNK = 64, 1 << 18

#: Characters that separate words: blank and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE, _BASE_W = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_powers: dict[int, list[np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; base is odd."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        inverse = _U(pow(int(base), -1, 2**64))
        have = []
        for b in (base, inverse):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            have.append(np.cumprod(x))
        if n <= 2 * SLICE_BYTES + 1:
            _powers[int(base)] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes, in ascending order: polynomials of up to LONG_RUN bytes, BLAKE2 digests of longer ones.

    Runs are hashed CHUNK bytes at a time, so that what this takes beside the text does not grow with it.
    """
    sizes = ends - starts
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, side="right")))
        lo, hi = starts[at], ends[to - 1]
        if hi - lo <= CHUNK:
            up, down = powers(_BASE, hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
            first, last = starts[at:to] - lo, ends[at:to] - lo
            out[at:to] = mix((sums[last] - sums[first]) * down[first] + sizes[at:to].astype(np.uint64))
        at = to
    for i in np.flatnonzero(sizes > LONG_RUN).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each row: byte bounds, hashes, and each row's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~SPACE[data]
        lo, hi = offsets[:-1], offsets[1:]
        first = np.zeros(n + 1, bool)
        first[1:n] = word[1:] & ~word[:-1]
        some = hi > lo
        first[lo[some]] |= word[lo[some]]
        last = np.zeros(n + 1, bool)
        last[: max(n - 1, 0)] = word[:-1] & ~word[1:]
        last[hi[some] - 1] |= word[hi[some] - 1]
        self.starts = np.flatnonzero(first[:n])
        self.ends = np.flatnonzero(last[:n]) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def windows(values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all runs of `size` values that lie within one row.

    Returns the hashes, the index of each one's first value, and its row.
    """
    n = len(values)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + size <= bounds[1:][rows]) if n else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(0, np.uint64), at, np.zeros(0, np.int64)
    up, down = powers(_BASE_W, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=sums[1:])
    return mix((sums[at + size] - sums[at]) * down[at]), at, rows[at]
