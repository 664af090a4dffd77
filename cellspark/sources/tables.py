"""Loading long tables and grids from JSON lines, their fingerprints, and reshaping into grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import few
from . import store
from .scratch import written

_LEVELS = [f"c{i}{k}" for i in range(1, 5) for k in ("_obj_nm", "", "_nm")]
OBS = T.StructType([*(T.StructField(n, T.StringType(), n not in ("src", "table_id", "prd_de")) for n in ("src", "table_id", "prd_de", "itm_id", "itm_nm", *_LEVELS, "unit_nm")), T.StructField("dt", T.DoubleType())])
#: The international tables' columns; all but `value` are texts.
OECD_COLUMNS = ("REF_AREA", "국가명", "SEX", "AGE", "LABOUR_FORCE_STATUS", "TIME_PERIOD", "WORKER_STATUS", "AGGREGATION_OPERATION", "MEASURE", "UNIT_MEASURE", "PRICE_BASE")
OECD = T.StructType([T.StructField("table_id", T.StringType(), False), *(T.StructField(n, T.StringType()) for n in OECD_COLUMNS), T.StructField("value", T.DoubleType())])
GRID = T.StructType([T.StructField("src", T.StringType()), T.StructField("sheet", T.StringType()), T.StructField("r", T.IntegerType()), T.StructField("c", T.IntegerType()), T.StructField("v_num", T.DoubleType()), T.StructField("v_txt", T.StringType())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, table, line, value, v: the lines of JSON files that aren't blank, but those of files whose names begin with 0_."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"), "value").filter(F.trim("value") != "")
    lines = lines.withColumns({"table": F.regexp_extract("file", r"([^/]+)\.jsonl$", 1), "v": F.try_parse_json("value")})
    return lines.filter(~F.col("table").startswith("0_"))


def _reason(kind: str) -> Column:
    """Why a line can't be loaded; null if it can."""
    reason = F.when(F.col("v").isNull(), "no JSON").when(~F.schema_of_variant("v").startswith("OBJECT"), "no object")
    if kind == "grid":
        return reason.when(F.try_variant_get("v", "$.r", "int").isNull() | F.try_variant_get("v", "$.c", "int").isNull(), "no place")
    return reason


def damaged_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """file, value, reason of the lines that a loader of this kind (obs, oecd or grid) refuses."""
    return _lines(spark, path).withColumn("reason", _reason(kind)).filter("reason is not null").select("file", "value", "reason")


def _sound(lines: DataFrame, kind: str, skip_damaged: bool) -> DataFrame:
    """The lines that can be loaded; another one ends the job with its file and text, or is left to damaged_lines()."""
    reason = _reason(kind)
    if skip_damaged:
        return lines.filter(reason.isNull())
    told = F.concat(F.lit("damaged line ("), reason, F.lit(") in "), "file", F.lit(": "), F.left("value", F.lit(200)))
    return lines.filter(F.when(reason.isNotNull(), F.raise_error(told).cast("boolean")).otherwise(True))


def load_obs(spark: SparkSession, path: str, src: str, skip_damaged: bool = False) -> DataFrame:
    """Observations from <table>.jsonl files with upper-case keys; rows without a period are dropped, a damaged line is an error."""
    names = [f.name for f in OBS if f.name not in ("src", "table_id")]
    df = _sound(_lines(spark, path), "obs", skip_damaged).select("table", *(F.try_variant_get("v", f"$.{n.upper()}", "string").alias(n) for n in names)).filter(F.col("prd_de").isNotNull())
    return df.select(F.lit(src).alias("src"), F.col("table").alias("table_id"), *(F.col(n).try_cast(OBS[n].dataType).alias(n) for n in names))


def load_oecd(spark: SparkSession, path: str, skip_damaged: bool = False) -> DataFrame:
    """Sparse international tables; a column that isn't known and isn't empty is an error, and so is a damaged line."""
    lines = _sound(_lines(spark, path), "oecd", skip_damaged)
    keys = lines.select(F.explode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("e"))
    unknown = keys.filter(~F.col("e.key").isin(*OECD_COLUMNS, "value") & (F.coalesce("e.value", F.lit("")) != "")).select("e.key").distinct().limit(20).collect()
    if unknown:
        raise ValueError(f"unknown columns with values: {', '.join(sorted(r.key for r in unknown))}")
    return lines.select(F.col("table").alias("table_id"), *(F.try_variant_get("v", f"$['{n}']", "string").alias(n) for n in OECD_COLUMNS), F.try_variant_get("v", "$.value", "string").try_cast("double").alias("value"))


def load_grid(spark: SparkSession, path: str, src: str, skip_damaged: bool = False) -> DataFrame:
    """Cells {"r", "c", "v"}: JSON numbers are numbers, texts, truth values and the rest stay texts, blanks are left out, the last line for a place wins; a damaged line is an error."""
    lines = _sound(_lines(spark, path), "grid", skip_damaged)
    kind = F.schema_of_variant(F.try_variant_get("v", "$.v", "variant"))
    cells = lines.select(F.col("table").alias("sheet"), "line", F.try_variant_get("v", "$.r", "int").alias("r"), F.try_variant_get("v", "$.c", "int").alias("c"), kind.alias("kind"), F.try_variant_get("v", "$.v", "double").alias("n"), F.try_variant_get("v", "$.v", "string").alias("t"))
    number = F.col("kind").rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    cells = cells.select("sheet", "line", "r", "c", F.when(number, F.col("n")).alias("v_num"), F.when(~number & (F.trim("t") != ""), F.col("t")).alias("v_txt"))
    last = F.row_number().over(W.partitionBy("sheet", "r", "c").orderBy(F.desc("line")))
    there = cells.filter(F.col("v_num").isNotNull() | F.col("v_txt").isNotNull()).withColumn("_nth", last).filter("_nth = 1")
    return there.select(F.lit(src).alias("src"), "sheet", "r", "c", "v_num", "v_txt")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with row numbers from 1 in the given order; beyond a few rows, range partitions are numbered one by one and offset by their sizes."""
    if few(df):
        return df.withColumn(name, F.row_number().over(W.orderBy(*order)))
    laid = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    sizes = laid.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return laid.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + own).drop("_part", "_before")


def melt(df: DataFrame, src: str, sheet: str, order: list[str], header: bool = True) -> DataFrame:
    """A wide table as a grid: row numbers in the given order, behind a row of column names."""
    names, kinds = df.columns, dict(df.dtypes)
    rows = numbered(df, order, "_r").withColumn("_r", F.col("_r") + int(header))
    cells = F.array(*(F.struct(F.lit(i + 1).alias("c"), (F.col(n).cast("double") if kinds[n] != "string" else F.lit(None).cast("double")).alias("v_num"), (F.col(n) if kinds[n] == "string" else F.lit(None).cast("string")).alias("v_txt")) for i, n in enumerate(names)))
    out = rows.select(F.col("_r").cast("int").alias("r"), F.inline(cells))
    if header:
        out = out.union(df.sparkSession.createDataFrame([(1, i + 1, None, n) for i, n in enumerate(names)], "r int, c int, v_num double, v_txt string"))
    out = out.filter(F.col("v_num").isNotNull() | F.col("v_txt").isNotNull())
    return out.select(F.lit(src).alias("src"), F.lit(sheet).alias("sheet"), "r", "c", "v_num", "v_txt")


def header_row(grid: DataFrame, within: int = 10, least: int = 2) -> DataFrame:
    """src, sheet, header: the first of the first rows that has at least two cells; sheets without one are missing."""
    rows = grid.filter(F.col("r") <= within).groupBy("src", "sheet", "r").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return rows.groupBy("src", "sheet").agg(F.min("r").alias("header"))


def latest(files: DataFrame, key: str = "part", path: str = "path") -> DataFrame:
    """Of each part's files, the one whose name comes last."""
    return files.groupBy(key).agg(F.max(path).alias(path))


def fingerprint(long: DataFrame, table: str, period: str) -> DataFrame:
    """Rows and last period of each table."""
    return long.groupBy(F.col(table).alias("table_id")).agg(F.count("*").alias("rows"), F.max(period).alias("max_period"))


def grid_fingerprint(grid: DataFrame) -> DataFrame:
    return grid.groupBy("src").agg(F.count("*").alias("rows"), F.countDistinct("sheet").alias("sheets"))


def lines_of(words: DataFrame, tolerance: float, page: str = "page", y: str = "y") -> DataFrame:
    """words with line: places on a page less than the tolerance below their predecessor share a line."""
    w = W.partitionBy(page).orderBy(y)
    new = F.coalesce(F.col(y) - F.lag(y).over(w) > tolerance, F.lit(True)).cast("int")
    return words.withColumn("_new", new).withColumn("line", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def explode_cells(documents: DataFrame, column: str) -> DataFrame:
    """part, sheet, ref, value of a document column map<sheet, map<ref, text>>."""
    sheets = documents.select("part", F.explode(column).alias("sheet", "_cells"))
    return sheets.select("part", "sheet", F.explode("_cells").alias("ref", "value"))


def coordinates(ref: Column) -> tuple[Column, Column]:
    """r and c of a reference such as $B$12, as expressions."""
    letters, digits = F.regexp_extract(ref, r"^\$?([A-Z]+)", 1), F.regexp_extract(ref, r"(\d+)$", 1)
    codes = F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), lambda x: F.ascii(x) - 64)
    return digits.try_cast("int"), F.aggregate(codes, F.lit(0), lambda a, x: a * 26 + x)


def own_row(ref: Column, row: int | None = None) -> Column:
    """ROW(): the row of the cell that asks, or a given one; a reference that is none gives null."""
    return F.lit(row) if row is not None else coordinates(ref)[0]


def write_parts(df: DataFrame, root: str, name: str, *by: str) -> None:
    """Parquet, one folder per part, as a new version of the store at root."""
    store.publish(df.sparkSession, root, {name: df}, by=by)


def write_documents(df: DataFrame, root: str, name: str) -> None:
    """JSON lines, as a new version of the store at root."""
    store.publish(df.sparkSession, root, {name: df}, "json")


def load_all(spark: SparkSession, root: str, long: tuple[str, ...] = ("kosis",), sparse: tuple[str, ...] = ("oecd",), grids: tuple[str, ...] = ("etc", "panel")) -> dict[str, DataFrame]:
    """obs, oecd_obs and grid from a folder of folders of JSON lines."""
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return {
        "obs": union([load_obs(spark, f"{root}/{s}", s) for s in long]),
        "oecd_obs": union([load_oecd(spark, f"{root}/{s}") for s in sparse]),
        "grid": union([load_grid(spark, f"{root}/grid/{s}", s) for s in grids]),
    }


def smoke(df: DataFrame, checks: dict[str, Column]) -> list[str]:
    """Names of the checks that no row meets; one scan for all."""
    got = df.agg(*(F.coalesce(F.bool_or(c), F.lit(False)).alias(name) for name, c in checks.items())).first()
    return [name for name in checks if not got[name]]


def cell_text(value: Column) -> Column:
    """A cell's text without blanks around it; blank cells are null."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))
