"""Tables that cut a query's lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Paths made inside the innermost released() of this thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; on one machine without that setting, below its own temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/cellspark-scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end: what was built on them must have been written or collected by then."""
    mine: list[str] = []
    token = _made.set(mine)
    try:
        yield
    finally:
        _made.reset(token)
        jvm = spark._jvm
        for path in mine:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Growing:
    """A table that rounds add rows to; what was written before is never written again."""

    def __init__(self, name: str):
        self.name, self.paths = name, []

    def add(self, df: DataFrame) -> DataFrame:
        """The new rows alone."""
        path = shared_path(df.sparkSession, self.name)
        df.write.parquet(path)
        self.paths.append(path)
        self.spark, self.schema = df.sparkSession, df.schema
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The new rows alone, and their number as counted by the write."""
        n = Observation()
        return self.add(df.observe(n, F.count("*").alias("n"))), n.get["n"]

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def text_lines(df: DataFrame, name: str) -> str:
    """df(value) as lines of text in files called <name>.jsonl, one folder each; a pattern for their paths."""
    path = shared_path(df.sparkSession, name)
    df.write.text(f"{path}/parts")
    jvm = df.sparkSession._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    for i, status in enumerate(fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/parts"))):
        if status.getPath().getName().startswith("part-"):
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/{i}"))
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{i}/{name}.jsonl"))
    return f"{path}/[0-9]*/{name}.jsonl"


def json_lines(df: DataFrame, name: str) -> str:
    """df as JSON lines, as in text_lines; null columns are left out of their line."""
    return text_lines(df.select(F.to_json(F.struct("*")).alias("value")), name)
