"""Stores that are replaced whole or not at all.

A store is a folder with versions of its tables and a pointer to the current one. All
tables of a new version are written first; then the pointer is renamed into place. Readers
see the former version until then, and a job that fails on the way changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "current"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> str | None:
    """The current version's folder, or None if nothing has been published."""
    if not _files(spark, root).exists(_path(spark, f"{root}/{POINTER}")):
        return None
    return f"{root}/{spark.read.text(f'{root}/{POINTER}').first()[0]}"


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], form: str = "parquet", by: tuple[str, ...] = ()) -> str:
    """Write tables (name -> rows) as a new version and point to it; tables that are not named are those of the former version.

    by: columns with a folder for each value. Two writers at once: the later pointer wins, and both versions are whole.
    """
    files, version = _files(spark, root), f"version-{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            df.write.partitionBy(*by).format(form).save(f"{root}/{version}/{name}")
        before = current(spark, root)
        if before:
            for status in files.listStatus(_path(spark, before)):
                name = status.getPath().getName()
                if name not in tables:
                    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, status.getPath(), files, _path(spark, f"{root}/{version}/{name}"), False, spark._jsc.hadoopConfiguration())
        staged = _path(spark, f"{root}/{version}/{POINTER}")
        out = files.create(staged)
        out.write(bytearray(version.encode()))
        out.close()
        jvm = spark._jvm
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        target = files.makeQualified(_path(spark, f"{root}/{POINTER}"))
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(staged), target, overwrite)
    except Exception:
        files.delete(_path(spark, f"{root}/{version}"), True)
        raise
    return f"{root}/{version}"


def table(spark: SparkSession, root: str, name: str, form: str = "parquet") -> DataFrame:
    """A table of the current version."""
    at = current(spark, root)
    if at is None:
        raise ValueError(f"nothing has been published at {root}")
    return spark.read.format(form).load(f"{at}/{name}")


def clear(spark: SparkSession, root: str) -> None:
    """Delete all versions but the current one: when no reader uses them any longer."""
    at = (current(spark, root) or "").rpartition("/")[2]
    for status in _files(spark, root).listStatus(_path(spark, root)):
        if status.isDirectory() and status.getPath().getName() not in (at, POINTER):
            _files(spark, root).delete(status.getPath(), True)
