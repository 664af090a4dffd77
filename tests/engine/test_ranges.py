"""Ranges by tiles and first hits along lines against loops over all cells."""

import random

import pytest
from pyspark.sql import functions as F

from cellspark.functions.criteria import split
from cellspark.operators import aggregates, lookups, ranges, scans

CELLS = "part string, sheet string, r int, c int, num double, txt string"


def sheet(r, n):
    places = r.sample([(a, b) for a in range(1, 90) for b in range(1, 20)], n)
    return [("p", r.choice("ST"), a, b, *r.choice([(float(r.randint(-9, 9)), None), (None, "x"), (None, ""), (None, None)])) for a, b in places]


@pytest.mark.parametrize(("radix", "sizes"), [(4, 12), (2, 3), (8, 2)])
def test_tiles_equal_a_loop(spark, monkeypatch, radix, sizes):
    monkeypatch.setattr(ranges, "BITS", radix.bit_length() - 1)
    monkeypatch.setattr(ranges, "SIZES", sizes)
    r = random.Random(radix)
    cells = sheet(r, 700)
    asked = [(i, "p", r.choice(["S", "T", "none"]), r.randint(0, 90), r.randint(0, 20), r.randint(0, 95), r.randint(0, 21)) for i in range(80)]
    most = (1_048_576, 16_384) if sizes == 12 else (200, 30)
    asked += [(0, "p", "S", 1, 1, 50, 5), (1, "p", "S", 5, 5, 5, 5), (200, "p", "S", 1, 1, *most), (201, "p", "S", 9, 2, 3, 4)]
    single = [(0, 100.0, None), (300, 7.0, None), (300, None, "t"), (301, None, None)]
    got = ranges.range_aggregates(spark.createDataFrame(asked, "qid int, part string, sheet string, r1 int, c1 int, r2 int, c2 int"), spark.createDataFrame(cells, CELLS), spark.createDataFrame(single, "qid int, num double, txt string"))
    want: dict = {q[0]: [] for q in asked} | {q[0]: [] for q in single}
    for i, part, s, r1, c1, r2, c2 in asked:
        want[i] += [(n, t) for p, sh, a, b, n, t in cells if (p, sh) == (part, s) and r1 <= a <= r2 and c1 <= b <= c2]
    for i, n, t in single:
        want[i].append((n, t))
    number = lambda v: [n for n, _ in v if n is not None]
    assert {x.qid: (x.total, x.largest, x.filled) for x in got.collect()} == {i: (sum(number(v)), max(number(v), default=0.0), sum(n is not None or bool(t) for n, t in v)) for i, v in want.items()}


def test_many_ranges_make_few_rows(spark):
    """Long overlapping ranges over one sheet: tiles are few per range, and no join compares places."""
    asked = spark.range(2000).select(F.col("id").alias("qid"), F.lit("p").alias("part"), F.lit("S").alias("sheet"), (F.col("id") % 700 + 1).alias("r1"), F.lit(1).alias("c1"), (F.col("id") % 700 + 60_000).alias("r2"), F.lit(1).alias("c2"))
    found = ranges.tiles(asked)
    assert found.count() < 2000 * 6 * 9  # 3 of each size on either side
    cells = spark.range(1, 100_001).select(F.lit("p").alias("part"), F.lit("S").alias("sheet"), F.col("id").cast("int").alias("r"), F.lit(1).alias("c"), F.lit(1.0).alias("num"), F.lit(None).cast("string").alias("txt"))
    got = ranges.range_aggregates(asked, cells)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert got.filter("total <> 60000 or filled <> 60000").count() == 0


@pytest.mark.parametrize("along", ["r", "c"])
def test_first_hits_equal_a_loop(spark, along):
    r = random.Random(len(along))
    cells = [("p", "S", a, b, *r.choice([(1.0, None), (2.0, None), (-0.0, None), (None, "x"), (None, " X"), (None, "1")])) for a in range(1, 60) for b in range(1, 60) if r.random() < 0.5]
    asked = [(i, "p", "S", r.randint(1, 50), r.randint(1, 50), r.randint(1, 60), r.randint(1, 60), r.randint(1, 3), *r.choice([(1.0, None), (0.0, None), (None, "x"), (None, "0"), (None, "*"), (9.0, None)])) for i in range(150)]
    got = lookups.page_lookup(spark.createDataFrame(asked, "qid int, part string, sheet string, r1 int, c1 int, r2 int, c2 int, index int, num double, txt string"), spark.createDataFrame(cells, CELLS), along)
    at = {(a, b): (n, t) for _, _, a, b, n, t in cells}

    def key(n, t):
        if n is None and t is not None and t.strip().replace(".", "").isdigit():
            n = float(t)
        return None if (n, t) == (None, None) else n + 0.0 if n is not None else t.strip().upper()

    def want(r1, c1, r2, c2, index, n, t):
        if t == "*":
            return None, None
        line = [(r1 + i, c1) for i in range(r2 - r1 + 1)] if along == "r" else [(r1, c1 + i) for i in range(c2 - c1 + 1)]
        hit = next((p for p in line if p in at and key(*at[p]) == key(n, t)), None)
        if hit is None:
            return None, None
        to = (hit[0], c1 + index - 1) if along == "r" else (r1 + index - 1, hit[1])
        if to[0] > r2 or to[1] > c2:
            return None, None
        return at.get(to, (0.0, None))

    assert {x.qid: (x.num, x.txt) for x in got.collect()} == {q[0]: want(*q[3:]) for q in asked}


def test_a_column_of_one_value_makes_no_pairs(spark):
    places = spark.range(20_000).select(F.lit("k").alias("key"), F.col("id").alias("at"))
    asked = spark.range(20_000).select(F.lit("k").alias("key"), (F.col("id") + 5000).alias("first"), F.col("id").alias("qid"))
    got = scans.successors(asked, places, ["key"], "first", "at", "hit")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SinglePartition" not in plan and "SortMergeJoin" not in plan
    assert got.filter("not hit <=> if(first < 20000, first, null)").count() == 0 and got.count() == 20_000


def test_zero_and_minus_zero_are_one_needle(spark):
    grid = spark.createDataFrame([("e", "S", 1, 1, -0.0, None), ("e", "S", 1, 2, 7.0, None)], "src string, sheet string, r int, c int, v_num double, v_txt string")
    needles = spark.createDataFrame([(1, "e", "S", "0"), (2, "e", "S", "-0")], "qid int, src string, sheet string, needle string")
    assert {x.qid: x.num for x in lookups.vlookup(needles, grid, 1, 2).collect()} == {1: 7.0, 2: 7.0}
    ranged = grid.select(F.col("c").alias("pos"), F.col("v_num").alias("num"), F.col("v_txt").alias("txt"))
    assert {x.qid: x.pos for x in lookups.match(needles, ranged).collect()} == {1: 1, 2: 1}
    assert aggregates.grid_conditional(grid, "e", "S", 2, {1: split("0")}).first().matches == 1


def test_sheets_are_numbered_without_whole_sheets_in_a_task(spark, small, monkeypatch):
    from cellspark import catalogue_bulk

    got = catalogue_bulk._line_sheets(spark, small)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "scan_part" in plan
    r = got.filter("c = 1").groupBy("sheet").agg(F.min("r").alias("a"), F.max("r").alias("z"), F.count_distinct("r").alias("n")).collect()
    assert r and all(x.a == 1 and x.z == x.n for x in r)


def test_lookups_lay_only_what_questions_reach(spark, monkeypatch):
    laid = []
    monkeypatch.setattr(lookups, "successors", lambda asked, places, *a, f=scans.successors: (laid.append(places.count()), f(asked, places, *a))[1])
    cells = spark.range(1, 3001).select(F.lit("p").alias("part"), F.lit("S").alias("sheet"), F.col("id").cast("int").alias("r"), F.explode(F.array(F.lit(1), F.lit(2))).alias("c"), (F.col("id") % 10).cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))
    asked = spark.createDataFrame([(1, "p", "S", 100, 1, 120, 2, 2, 7.0, None), (2, "p", "S", 108, 1, 112, 2, 2, 7.0, None), (3, "p", "S", 5, 1, 4, 2, 2, 7.0, None)], "qid int, part string, sheet string, r1 int, c1 int, r2 int, c2 int, index int, num double, txt string")
    assert {x.qid: x.num for x in lookups.page_lookup(asked, cells, "r").collect()} == {1: 7.0, 2: None, 3: None}
    assert laid == [2]


def test_tiles_are_added_up_from_smaller_ones(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(ranges, "written", lambda df, name, f=ranges.written: sizes.append((name, (out := f(df, name)).count())) or out)
    cells = spark.range(1, 4097).select(F.lit("p").alias("part"), F.lit("S").alias("sheet"), F.col("id").cast("int").alias("r"), F.lit(1).alias("c"), F.lit(1.0).alias("num"), F.lit(None).cast("string").alias("txt"))
    asked = spark.createDataFrame([(1, "p", "S", 3, 1, 1500, 1), (2, "p", "S", 1000, 1, 2040, 1)], "qid int, part string, sheet string, r1 int, c1 int, r2 int, c2 int")
    assert {x.qid: (x.total, x.largest, x.filled) for x in ranges.range_aggregates(asked, cells).collect()} == {1: (1498.0, 1.0, 1498), 2: (1041.0, 1.0, 1041)}
    heights = [n for name, n in sizes if name == "heights"]
    assert heights[0] == 2038 and sum(heights) < 2038 * 3 / 2
