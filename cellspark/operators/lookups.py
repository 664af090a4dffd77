"""Lookups: cells by coordinate, vertical and horizontal search, index and match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ascii_fold, literal_needle, text_number
from .aggregates import small
from .scans import successors


def keyed(num: Column, txt: Column) -> Column:
    """One join key for both: a number's shortest text (0 and -0 are one), or the folded text."""
    return F.coalesce(F.concat(F.lit("n"), (num + F.lit(0.0)).cast("string")), F.concat(F.lit("t"), ascii_fold(txt)))


def keys_of(needle: Column) -> Column:
    """The keys that a needle can meet; one with a pattern meets none."""
    needle = literal_needle(needle)
    number = F.when(F.trim(needle) != "", text_number(needle))
    return F.array_compact(F.array(F.concat(F.lit("t"), ascii_fold(needle)), F.concat(F.lit("n"), (number + F.lit(0.0)).cast("string"))))


def search(needles: DataFrame, grid: DataFrame, along: str, line: int, index: Column) -> DataFrame:
    """qid, num, txt: the cell that lies `index` - 1 lines beyond the first hit of each needle.

    needles(qid, src, sheet, needle); along: "r" searches down column `line`
    (vertical lookup), "c" along row `line` (horizontal). No hit: both null. A
    hit on a blank cell: 0, as a spreadsheet shows it.
    """
    across = "c" if along == "r" else "r"
    hay = grid.filter(F.col(across) == line).select("src", "sheet", F.col(along).alias("at"), keyed(F.col("v_num"), F.col("v_txt")).alias("key")).filter("key is not null")
    asked = needles.select("qid", "src", "sheet", F.explode(keys_of(F.col("needle"))).alias("key"))
    # First hit per key before the join: repeated keys cost nothing.
    first = hay.groupBy("src", "sheet", "key").agg(F.min("at").alias("at"))
    hits = asked.join(small(first), ["src", "sheet", "key"]).groupBy("qid", "src", "sheet").agg(F.min("at").alias("at"))
    hits = hits.withColumn("to", F.lit(line) + index - 1)
    cells = grid.select("src", "sheet", F.col(along).alias("at"), F.col(across).alias("to"), "v_num", "v_txt", F.lit(True).alias("there"))
    got = hits.join(cells, ["src", "sheet", "at", "to"], "left")
    got = got.select("qid", F.when(F.col("there"), F.col("v_num")).otherwise(0.0).alias("num"), F.col("v_txt").alias("txt"))
    return needles.select("qid").join(got, "qid", "left")


def vlookup(needles: DataFrame, grid: DataFrame, column: int, index: int) -> DataFrame:
    return search(needles, grid, "r", column, F.lit(index))


def hlookup(needles: DataFrame, grid: DataFrame, row: int, index: int) -> DataFrame:
    return search(needles, grid, "c", row, F.lit(index))


def cell_key(num: Column, txt: Column) -> Column:
    """One join key for cells that are equal on a page: a number and the texts that spell it, or a text without blanks around it in either case."""
    number = F.coalesce(num, F.when(F.trim(txt) != "", text_number(txt)))
    return F.coalesce(F.concat(F.lit("n"), (number + F.lit(0.0)).cast("string")), F.concat(F.lit("t"), F.upper(F.trim(txt))))


def page_lookup(needles: DataFrame, cells: DataFrame, along: str) -> DataFrame:
    """qid, num, txt of lookups inside a page's cells(part, sheet, r, c, num, txt).

    needles(qid, part, sheet, r1, c1, r2, c2, index, num, txt): the needle is
    searched down the first column (along "r") or across the first row ("c") of its
    range, and the cell `index` - 1 lines beyond the first hit is the result: 0 if
    it is blank, an error (both null) if it lies outside the range or nothing was hit.
    """
    across = "c" if along == "r" else "r"
    hay = cells.select("part", "sheet", F.col(along).alias("at"), F.col(across).alias("line"), cell_key(F.col("num"), F.col("txt")).alias("key")).filter("key is not null")
    asked = needles.select("qid", "part", "sheet", F.col(f"{along}1").alias("first"), F.col(f"{along}2").alias("last"), F.col(f"{across}1").alias("line"), F.col(f"{across}2").alias("most"), "index", cell_key(F.col("num"), literal_needle(F.col("txt"))).alias("key"))
    # Of each key only the stretch is laid that some question can reach, and of the results' lines likewise.
    reach = lambda *by: asked.filter("first <= last").groupBy(*by).agg(F.min("first").alias("low"), F.max("last").alias("high"))
    keys = ["part", "sheet", "line", "key"]
    hay = hay.join(small(reach(*keys)), keys).filter("at between low and high").drop("low", "high")
    # The first place of the key from the range's beginning on: a key's repeats cost nothing.
    hits = successors(asked.filter("key is not null"), hay, ["part", "sheet", "line", "key"], "first", "at", "at").filter("at <= last")
    hits = hits.withColumn("to", F.col("line") + F.col("index") - 1).filter("to <= most")
    there = cells.select("part", "sheet", F.col(along).alias("at"), F.col(across).alias("to"), "num", "txt")
    there = there.join(small(reach("part", "sheet", (F.col("line") + F.col("index") - 1).alias("to"))), ["part", "sheet", "to"]).filter("at between low and high").drop("low", "high")
    got = hits.join(there, ["part", "sheet", "at", "to"], "left").select("qid", F.when(F.col("txt").isNull(), F.coalesce("num", F.lit(0.0))).alias("num"), "txt")
    return needles.select("qid").join(got, "qid", "left")


def deref(refs: DataFrame, cells: DataFrame, computed: DataFrame | None = None) -> DataFrame:
    """refs(part, sheet, r, c, ...) with num, txt: a computed cell first, then the page's own, else blank."""
    at = ["part", "sheet", "r", "c"]
    out = refs.join(cells.select(*at, F.col("num").alias("page_num"), F.col("txt").alias("page_txt")), at, "left")
    if computed is None:
        return out.withColumnsRenamed({"page_num": "num", "page_txt": "txt"})
    out = out.join(computed.select(*at, "num", "txt", F.lit(True).alias("known")), at, "left")
    pick = lambda k: F.when(F.col("known"), F.col(k)).otherwise(F.col(f"page_{k}")).alias(k)
    return out.select(*refs.columns, pick("num"), pick("txt"))


def external_cell(refs: DataFrame, grid: DataFrame) -> DataFrame:
    """refs(src, sheet, r, c, ...) with num, txt of the grid's cell; a missing cell is 0."""
    out = refs.join(grid, ["src", "sheet", "r", "c"], "left")
    return out.select(*refs.columns, F.when(F.col("v_txt").isNull(), F.coalesce("v_num", F.lit(0.0))).alias("num"), F.col("v_txt").alias("txt"))


def positions(cells: DataFrame, r1: int, c1: int, r2: int, c2: int) -> DataFrame:
    """Cells of a rectangle with pos, from 1, row by row."""
    inside = cells.filter(F.col("r").between(r1, r2) & F.col("c").between(c1, c2))
    return inside.withColumn("pos", (F.col("r") - r1) * (c2 - c1 + 1) + F.col("c") - c1 + 1)


def dense(spark, cells: DataFrame, r1: int, c1: int, r2: int, c2: int) -> DataFrame:
    """pos, num, txt for every place of a rectangle, blank cells included."""
    n = (r2 - r1 + 1) * (c2 - c1 + 1)
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias("pos")).join(positions(cells, r1, c1, r2, c2).select(F.col("pos").cast("int").alias("pos"), "num", "txt"), "pos", "left")


def match(needles: DataFrame, ranged: DataFrame) -> DataFrame:
    """qid, pos: the first place in ranged(pos, num, txt) of each needle of needles(qid, needle), or null."""
    hay = ranged.select("pos", keyed(F.col("num"), F.col("txt")).alias("key")).filter("key is not null").groupBy("key").agg(F.min("pos").alias("pos"))
    asked = needles.select("qid", F.explode(keys_of(F.col("needle"))).alias("key"))
    hits = asked.join(small(hay), "key").groupBy("qid").agg(F.min("pos").alias("pos"))
    return needles.select("qid").join(hits, "qid", "left")


def index(places: DataFrame, ranged: DataFrame, size: int) -> DataFrame:
    """qid, num, txt of the places(qid, pos): a blank cell is 0, a place outside the range an error (both null)."""
    got = places.join(ranged.select("pos", "num", "txt"), "pos", "left")
    inside = F.col("pos").between(1, size) & (F.col("pos") == F.floor("pos"))
    return got.select("qid", F.when(inside & F.col("txt").isNull(), F.coalesce("num", F.lit(0.0))).alias("num"), F.when(inside, F.col("txt")).alias("txt"))
