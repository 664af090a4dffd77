"""Operators on small tables, with blanks, ties and empty inputs."""

import json
import math

import pytest
from pyspark.sql import functions as F

from cellspark.functions import criteria as cr
from cellspark.operators import aggregates, lookups, publish, ranges, ranking, series, verification
from cellspark.plans import levels
from cellspark.sources import store, tables
from cellspark.streaming import refresh

GRID = [("etc", "S", r, c, n, t) for r, c, n, t in [(1, 1, None, "구분"), (1, 2, None, "값"), (2, 1, None, "POP"), (2, 2, 10.0, None), (2, 3, None, "2025년"), (3, 1, None, "pop"), (3, 2, 5.0, None), (3, 3, None, "2025년"), (4, 1, None, "ETC"), (4, 2, 7.0, None), (4, 3, None, "2025년"), (5, 1, None, "빈값행"), (5, 3, None, "2025년")]]


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(GRID, tables.GRID)


@pytest.fixture(scope="module")
def obs(spark):
    return spark.createDataFrame([("2024", "취업자", "계", 100.0), ("2025", "취업자", "계", 120.0), ("2025", "취업자", "남자", 70.0), ("2025", "실업자", None, 5.0)], "prd string, itm string, c1 string, dt double")


def test_conditional(spark, obs):
    q = spark.createDataFrame([(1, "2025", "취업자"), (2, "2030", "취업자"), (3, "2025", "취업자"), (4, None, "취업자")], "qid int, y string, i string")
    got = lambda agg, empty=0: {r.qid: r.value for r in aggregates.conditional(obs, q, {"prd": "y", "itm": "i"}, agg, empty=empty).collect()}
    assert got(F.sum("dt")) == {1: 190, 2: 0, 3: 190, 4: 0}
    assert got(F.count("c1")) == {1: 2, 2: 0, 3: 2, 4: 0}
    assert got(F.avg("dt"), None) == {1: 95, 2: None, 3: 95, 4: None}
    assert aggregates.conditional(obs.limit(0), q, {"prd": "y"}, F.sum("dt")).filter("value <> 0").count() == 0
    assert aggregates.conditional(obs, q.limit(0), {"prd": "y"}, F.sum("dt")).count() == 0


def test_conditional_with_comparison_and_without_broadcast(spark, obs, monkeypatch):
    monkeypatch.setattr(aggregates, "MOST_BROADCAST", 0)
    q = spark.createDataFrame([(1, "2025", 60.0), (2, "2025", 500.0)], "qid int, y string, least double")
    got = aggregates.conditional(obs, q, {"prd": "y"}, F.count("*"), {"dt": (">", "least")})
    assert {r.qid: r.value for r in got.collect()} == {1: 2, 2: 0}


def test_facts_are_not_shuffled_before_they_are_summed(spark, obs):
    q = spark.createDataFrame([(1, "2025")], "qid int, y string")
    plan = aggregates.conditional(obs, q, {"prd": "y"}, F.sum("dt"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


@pytest.mark.parametrize(("criteria", "total", "n"), [({1: "pop"}, 15, 2), ({1: "none"}, 0, 0), ({3: "2025년", 2: "<>10"}, 12, 2), ({1: "<>POP"}, 7, 2), ({1: "=", 2: ">1"}, 0, 0)])
def test_grid_conditional(grid, criteria, total, n):
    got = aggregates.grid_conditional(grid, "etc", "S", 2, {c: cr.split(k) for c, k in criteria.items()}).first()
    assert (got.total, got.matches) == (total, n)


def test_grid_count_universe(grid):
    got = aggregates.grid_conditional(grid, "etc", "S", None, {3: cr.split("2025년"), 2: cr.split("<>10")}).first()
    assert got.matches == 3
    with pytest.raises(ValueError):
        aggregates.grid_conditional(grid, "etc", "S", None, {2: cr.split("<>10")})


def test_lookups(spark, grid):
    needles = spark.createDataFrame([(1, "etc", "S", "Pop"), (2, "etc", "S", "빈값행"), (3, "etc", "S", "none"), (4, "etc", "S", None)], "qid int, src string, sheet string, needle string")
    assert {r.qid: (r.num, r.txt) for r in lookups.vlookup(needles, grid, 1, 2).collect()} == {1: (10, None), 2: (0, None), 3: (None, None), 4: (None, None)}
    across = spark.createDataFrame([(1, "etc", "S", "값")], "qid int, src string, sheet string, needle string")
    assert lookups.hlookup(across, grid, 1, 3).first().num == 5
    refs = spark.createDataFrame([(1, "etc", "S", 2, 2), (2, "etc", "S", 2, 3), (3, "etc", "S", 99, 1)], "qid int, src string, sheet string, r int, c int")
    assert {r.qid: (r.num, r.txt) for r in lookups.external_cell(refs, grid).collect()} == {1: (10, None), 2: (None, "2025년"), 3: (0, None)}


def test_cells_index_and_match(spark):
    cells = spark.createDataFrame([("p", "s", 1, 1, 10.0, None), ("p", "s", 2, 1, None, "x"), ("p", "s", 4, 1, 10.0, None)], "part string, sheet string, r int, c int, num double, txt string")
    computed = spark.createDataFrame([("p", "s", 2, 1, 7.0, None)], "part string, sheet string, r int, c int, num double, txt string")
    refs = spark.createDataFrame([(i, "p", "s", i, 1) for i in (1, 2, 3)], "qid int, part string, sheet string, r int, c int")
    assert {r.qid: (r.num, r.txt) for r in lookups.deref(refs, cells, computed).collect()} == {1: (10, None), 2: (7, None), 3: (None, None)}
    assert [(r.pos, r.num, r.txt) for r in lookups.dense(spark, cells, 1, 1, 4, 1).orderBy("pos").collect()] == [(1, 10, None), (2, None, "x"), (3, None, None), (4, 10, None)]
    column = lookups.positions(cells, 1, 1, 4, 1)
    found = lookups.match(spark.createDataFrame([(1, "10"), (2, "X"), (3, "none")], "qid int, needle string"), column)
    assert {r.qid: r.pos for r in found.collect()} == {1: 1, 2: 2, 3: None}
    at = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 5.0), (5, 1.5), (6, None)], "qid int, pos double")
    assert {r.qid: (r.num, r.txt) for r in lookups.index(at, column, 4).collect()} == {1: (10, None), 2: (None, "x"), 3: (0, None), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_ranges(spark):
    cells = spark.createDataFrame([("p", "s", i + 1, 1, n, t) for i, (n, t) in enumerate([(1.0, None), (None, "문자"), (None, None), (2.5, None), (None, ""), (10.0, None)])], "part string, sheet string, r int, c int, num double, txt string")
    rect = spark.createDataFrame([(1, "p", "s", 1, 1, 6, 1), (2, "p", "none", 1, 1, 6, 1)], "qid int, part string, sheet string, r1 int, c1 int, r2 int, c2 int")
    assert {r.qid: (r.total, r.largest, r.filled) for r in ranges.range_aggregates(rect, cells).collect()} == {1: (13.5, 10, 4), 2: (0, 0, 0)}


def test_ranking(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "a", 30.0), (3, "a", 20.0), (4, "a", 30.0), (5, "a", None), (6, "b", 1.0)], "k int, g string, x double")
    rank = ranking.rank_descending(df, "x", ["g"])
    assert {r.k: r["rank"] for r in rank.collect()} == {1: 4, 2: 1, 3: 3, 4: 1, 5: None, 6: 1}
    both = ranking.sort_position(ranking.running_count(rank, "x", "k", ["g"]), "x", "k", ["g"]).filter("x is not null")
    assert both.filter("pos <> rank + nth - 1").count() == 0
    assert {r.k: r["rank"] for r in ranking.rank_where(df, "x", F.col("x") < 30, ["g"]).collect()} == {1: 2, 2: None, 3: 1, 4: None, 5: None, 6: 1}


def test_series(spark):
    assert [r.year for r in series.years(spark, 2025, 3).orderBy("pos").collect()] == [2023, 2024, 2025]
    df = spark.createDataFrame([("s", 2019, 100.0), ("s", 2020, 100.0), ("s", 2021, 110.0), ("t", 2021, 0.0), ("t", 2022, 5.0)], "s string, y int, v double")
    got = {(r.s, r.y): (None if r.growth is None else round(r.growth, 9), r.growth_mark) for r in series.growth(df, "v", "y", ["s"]).collect()}
    assert got == {("s", 2019): (None, "-"), ("s", 2020): (None, "…"), ("s", 2021): (10, None), ("t", 2021): (None, "-"), ("t", 2022): (None, "-")}


def test_levels_and_values(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "x")], "cell string, needs string")
    cells = spark.createDataFrame([(c,) for c in "abcxyz"], "cell string")
    assert {r.cell: r.level for r in levels.levels(cells, edges).collect()} == {"a": 0, "b": 1, "c": 2, "x": None, "y": None, "z": None}
    assert {(r.cell, r.leaf) for r in levels.leaves(edges).collect()} == {("b", "a"), ("c", "a")}
    inputs = spark.createDataFrame([("a", 4.0), ("q", None)], "cell string, num double")
    specs = spark.createDataFrame([("s", "sum"), ("d", "div"), ("p", "pct_of"), ("bad", "div")], "cell string, shape string")
    needs = spark.createDataFrame([("s", 0, "a"), ("s", 1, "q"), ("s", 2, "a"), ("d", 0, "s"), ("d", 1, "a"), ("p", 0, "d"), ("p", 1, "s"), ("bad", 0, "a"), ("bad", 1, "nowhere")], "cell string, pos int, needs string")
    got = {r.cell: r.num for r in levels.evaluate(inputs, specs, needs).collect()}
    assert got == {"a": 4, "q": None, "s": 8, "d": 2, "p": 25, **({"bad": None} if "bad" in got else {})}


def test_levels_are_as_deep_as_the_chain(spark):
    # As the year chain of the reference's sheet _시계열: B1 is given, each cell needs the one after it.
    n = 24
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, n)] + [(90, 91), (91, 90), (92, 90)], "cell long, needs long")
    assert {r.cell: r.level for r in levels.levels(spark.createDataFrame([(i,) for i in [*range(n), 90, 91, 92]], "cell long"), edges).collect()} == {**{i: i for i in range(n)}, 90: None, 91: None, 92: None}
    inputs = spark.createDataFrame([("0", 2025.0), ("one", 1.0)], "cell string, num double")
    specs = spark.createDataFrame([(str(i), "sub") for i in range(1, n)] + [("x", "ref"), ("y", "ref"), ("z", "sum"), ("gap", "sum"), ("none", "sum")], "cell string, shape string")
    needs = [(str(i), p, c) for i in range(1, n) for p, c in enumerate([str(i - 1), "one"])] + [("x", 0, "y"), ("y", 0, "x"), ("z", 0, "x"), ("z", 1, "one"), ("gap", 0, "one"), ("gap", 1, "nowhere")]
    got = levels.evaluate(inputs, specs, spark.createDataFrame(needs, "cell string, pos int, needs string")).collect()
    assert len(got) == n + 6 and {r.cell: r.num for r in got} == {**{str(i): 2025.0 - i for i in range(n)}, "one": 1, "x": None, "y": None, "z": None, "gap": 1, "none": 0}


def test_verification(spark):
    at = "part string, sheet string, ref string"
    specs = spark.createDataFrame([("p", "s", f"A{i}", "expr") for i in range(1, 6)] + [("p", "s", "A6", "presentation"), ("p", "_h", "A1", "expr")], f"{at}, kind string")
    oracle = spark.createDataFrame([("p", "s", f"A{i}", float(i), None) for i in (1, 2, 3, 4, 6)], f"{at}, num double, txt string")
    got = spark.createDataFrame([("p", "s", "A1", 1.0, None, None), ("p", "s", "A2", 9.0, None, None), ("p", "s", "A3", None, None, "boom"), ("p", "s", "A4", 8.0, None, None)], f"{at}, num double, txt string, err string")
    v = verification.verdicts(specs, oracle, got)
    assert {r.ref: r.verdict for r in v.collect()} == {"A1": "match", "A2": "mismatch", "A3": "error", "A4": "mismatch", "A5": "no-oracle", "A6": "presentation"}
    pins = spark.createDataFrame([("p", "s", "A2", 2.0, 9.0), ("p", "s", "A4", 4.0, 7.0), ("p", "s", "A1", 1.0, 1.0), ("p", "s", "Z9", 1.0, 1.0)], f"{at}, e_num double, g_num double")
    after = verification.exempt(v, pins)
    assert {r.ref for r in after.filter("verdict = 'known-divergence'").collect()} == {"A2"}
    assert {r.ref: r.reason for r in verification.stale(pins, v).collect()} == {"A4": "the computed value has changed", "A1": "it matches now", "Z9": "the cell is gone"}
    rates = verification.rates(after)
    assert tuple(rates.first())[:3] == ("p", 4, 1)
    assert verification.floor_violations(rates, verification.Floor(1, 4)) == []
    assert len(verification.floor_violations(rates, verification.Floor(2, 5))) == 2 and verification.floor_violations(rates, None)
    with pytest.raises(ValueError):
        verification.raised(verification.Floor(2, 2), verification.Floor(2, 1))
    assert verification.reason_groups(spark.createDataFrame([("row 12 failed (x)", 2), ("row 7 failed", 1)], "r string, k int"), "r", "k").first().asDict() == {"key": "row # failed", "n": 2, "sample": 1}


def test_publishing(spark):
    cells = spark.createDataFrame([(s, r, c, float(r * 1234 + c * 77 + k)) for k, s in enumerate(("A", "B")) for r in range(1, 6) for c in range(1, 5)], "sheet string, r int, c int, num double")
    printed = cells.filter("sheet = 'B' and r < 4").select(F.lit("t").alias("table"), F.col("r").alias("i"), F.col("c").alias("j"), (F.floor(F.col("num") * 0.1 * 10 + 0.5) / 10).alias("value"), F.lit(1).alias("decimals"))
    best = publish.best_sheet(publish.value_votes(printed, cells)).first()
    assert (best.sheet, best.scale) == ("B", 0.1)
    s = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, "c"), (2, 1, None)], "chart int, series int, cat string")
    assert [r["cat"] for r in publish.inherit_categories(s).orderBy("chart", "series").collect()] == ["a", "a", "c", None]
    rows = spark.createDataFrame([("t", 1, ["a", "b", "c"]), ("t", 2, ["1", "2,000", "3%"]), ("u", 1, ["x"])], "table string, i int, cells array<string>")
    assert [r.table for r in publish.data_table(rows).collect()] == ["t"]
    assert [spark.range(1).select(publish.nice_top(F.lit(x)).alias("x")).first().x for x in (7.0, 12.0, 450.0, 1000.0)] == [10, 20, 500, 1000]
    assert [spark.range(1).select(publish.acceptance(F.lit(a), F.lit(n)).alias("x")).first().x for a, n in ((0.95, 4), (0.75, 3), (0.95, 2))] == ["ok", "weak", "fail"]


def test_loaders(spark, tmp_path):
    put = lambda name, rows: (tmp_path / name).write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
    put("DT_1.jsonl", [{"PRD_DE": "202508", "ITM_ID": "T1", "C4": "x", "DT": "1.5"}, {"ITM_ID": "T1", "DT": "2"}])
    put("0_list.jsonl", [{"PRD_DE": "2025", "DT": "1"}])
    got = tables.load_obs(spark, f"{tmp_path}/*.jsonl", "kosis").collect()
    assert [(r.table_id, r.prd_de, r.c4, r.dt, r.unit_nm) for r in got] == [("DT_1", "202508", "x", 1.5, None)]
    grid = tmp_path / "grid"
    grid.mkdir()
    (grid / "G.jsonl").write_text('{"r":1,"c":1,"v":"202508"}\n{"r":1,"c":2,"v":42.5}\n{"r":2,"c":1,"v":"  "}\n{"r":3,"c":1,"v":1}\n{"r":3,"c":1,"v":"later"}\n')
    assert sorted((r.sheet, r.r, r.c, r.v_num, r.v_txt) for r in tables.load_grid(spark, str(grid), "etc").collect()) == [("G", 1, 1, None, "202508"), ("G", 1, 2, 42.5, None), ("G", 3, 1, None, "later")]
    oecd = tmp_path / "oecd"
    oecd.mkdir()
    (oecd / "LFS.jsonl").write_text('{"REF_AREA":"KOR","TIME_PERIOD":2024,"value":"3.5","NEW":null}\n')
    assert [(r.table_id, r.TIME_PERIOD, r.value) for r in tables.load_oecd(spark, str(oecd)).collect()] == [("LFS", "2024", 3.5)]
    (oecd / "HW.jsonl").write_text('{"REF_AREA":"KOR","NEW":"x"}\n')
    with pytest.raises(ValueError):
        tables.load_oecd(spark, str(oecd))


def test_streaming_refresh_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "k string, v double")
    df.write.parquet(src)
    totals = refresh.running_totals(refresh.arriving(spark, src, df.schema), ["k"], "v")
    refresh.refresh(totals, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    df.write.mode("append").parquet(src)
    refresh.refresh(totals, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    last = spark.read.parquet(str(tmp_path / "out")).orderBy(F.desc("version"), "k").limit(2).collect()
    assert [(r.k, r.total, r.rows) for r in last] == [("a", 8, 4), ("b", 4, 2)]


def test_formulas(spark):
    from cellspark.sources import formulas

    rows = ["=SUMIFS('[1]a b'!$D$2:$D$9,[1]s!$A$2:$A$9,\"A1 \"\"(\")", "='[1]seat'!$A$1", "=A1/B2%", "=CELL(\"x\")&SUM(A1:A3)", "=OFFSET(A1,1)"]
    df = spark.createDataFrame(list(enumerate(rows)), "k int, formula string")
    f = F.col("formula")
    got = df.select(formulas.shape(f).alias("s"), formulas.functions_used(f).alias("u"), formulas.references(f).alias("r"), formulas.is_anchor(f, "seat").alias("a"), formulas.kind(f, "CELL(").alias("k")).collect()
    assert [r.s for r in got] == ["=SUMIFS(@,@,$)", "=@", "=@/@%", "=CELL($)&SUM(@)", "=OFFSET(@,#)"]
    assert [r.u for r in got] == [["SUMIFS"], [], [], ["CELL", "SUM"], ["OFFSET"]]
    assert got[0].r == ["'[1]a b'!$D$2:$D$9", "[1]s!$A$2:$A$9"] and got[2].r == ["A1", "B2"]
    assert [r.a for r in got] == [False, True, False, False, False]
    assert [r.k for r in got] == ["expr", "expr", "expr", "presentation", "unsupported"]
    areas = spark.range(1).select(formulas.areas(F.lit("('p8'!$B$4:$CX$4,C3)"), F.lit("h")).alias("x")).first().x
    assert [tuple(a) for a in areas] == [("p8", 4, 2, 4, 102), ("h", 3, 3, 3, 3)]


def test_greedy_pairs_bundle_and_prefer(spark):
    votes = spark.createDataFrame([("t", "s", 1.0, 1, 1, 0.9), ("t", "s", 1.0, 2, 1, 1.0), ("t", "s", 1.0, 2, 2, 0.95), ("t", "s", 1.0, 1, 3, 0.1)], "table string, sheet string, scale double, i int, r int, votes double")
    assert {(r.i, r.r) for r in publish.greedy_pairs(votes).collect()} == {(2, 1), (1, 3)}
    pages = spark.createDataFrame([(1, "a"), (2, "b")], "page int, title string")
    charts = spark.createDataFrame([(1, 1, 1, [1.0, None])], "page int, chart int, series int, values array<double>")
    cells = spark.createDataFrame([(1, 0, 0, 2.0, "v")], "page int, i int, j int, value double, source string")
    docs = {r.page: json.loads(r.document) for r in publish.bundle(pages, charts, cells).collect()}
    assert docs[1]["charts"][0]["values"] == [1.0, None] and docs[1]["cells"][0]["source"] == "v" and docs[2] == {"page": 2, "title": "b"}
    a, b = spark.createDataFrame([(1, None)], "k int, x double"), spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, x double")
    assert {r.k: r.x for r in publish.prefer(a, b, ["k"], ["x"]).collect()} == {1: None, 2: 6.0}
    assert tables.smoke(a, {"has one": F.col("k") == 1, "has two": F.col("k") == 2}) == ["has two"]
    assert [r.shown for r in spark.createDataFrame([(1234.5,), (123.45,), (1.5,), (2.0,)], "x double").select(publish.compact(F.col("x"))).collect()][0] in ("1,234", "1,235")


@pytest.mark.parametrize("op", [">=", ">", "<=", "<"])
def test_bounded_sums_equal_a_plain_loop(spark, op):
    facts = [("a", 1.0, 10.0), ("A", 2.0, 20.0), ("a", 2.0, 5.0), ("b", 2.0, 7.0), ("a", None, 99.0), ("a", 3.0, None), (None, 2.0, 50.0), ("", 6.0, 3.0), ("a", float("inf"), 1.0)]
    asked = [(1, "a", 2.0), (2, "B", 2.0), (3, "a", None), (4, "zz", 0.0), (5, None, 0.0), (6, "a", 2.0), (7, "a", -1.0), (8, "", 5.0)]
    meets = {">=": lambda x, y: x >= y, ">": lambda x, y: x > y, "<=": lambda x, y: x <= y, "<": lambda x, y: x < y}[op]
    # A null key of a question is the empty text; nulls of the facts match none.
    want = {i: sum(v or 0 for k, x, v in facts if x is not None and bound is not None and k is not None and k.lower() == (key or "").lower() and meets(x, bound)) for i, key, bound in asked}
    f = spark.createDataFrame(facts, "k string, x double, v double")
    q = spark.createDataFrame(asked, "qid int, k string, bound double")
    got = {r.qid: r.value for r in aggregates.bounded(f, q, {"k": "k"}, ("x", op, "bound"), F.col("v")).collect()}
    assert got == want
    none = aggregates.bounded(f.limit(0), q, {"k": "k"}, ("x", op, "bound"), F.col("v"), empty=None).collect()
    assert len(none) == len(asked) and all(r.value is None for r in none)
    assert {r.value for r in aggregates.bounded(f, q.select("qid", "bound"), {}, ("x", op, "bound"), F.col("v")).collect()} >= {0}


def test_bounds_alone_are_never_a_nested_loop(spark, obs):
    q = spark.createDataFrame([(i, float(i)) for i in range(3)], "qid int, least double")
    with pytest.raises(ValueError, match="bounded"):
        aggregates.conditional(obs, q, {}, F.sum("dt"), {"dt": (">=", "least")})


def test_numbering_a_large_table(spark, monkeypatch):
    from cellspark.operators import aggregates as sizes

    df = spark.createDataFrame([(i * 7 % 101, "x") for i in range(101)], "k int, v string").repartition(5)
    want = {(i, i + 1) for i in range(101)}
    assert {(r.k, r.n) for r in tables.numbered(df, ["k"], "n").collect()} == want
    monkeypatch.setattr(sizes, "MOST_BROADCAST", 10)
    assert {(r.k, r.n) for r in tables.numbered(df, ["k"], "n").collect()} == want
    assert tables.numbered(df.limit(0), ["k"], "n").count() == 0


def test_reports_and_snapshots(spark, tmp_path):
    at = "part string, sheet string, ref string, verdict string, e_num double, e_txt string, g_num double, g_txt string, reason string"
    rows = [("p", "s", "A1", "match", 1.0, None, 1.0, None, None), ("p", "s", "A2", "known-divergence", 1.0, None, None, "x", None), ("p", "s", "A3", "presentation", None, None, None, None, "left out: row 3")]
    good = spark.createDataFrame(rows, at)
    verification.write_report(good, f"{tmp_path}/report", "reason")
    read = lambda p: store.table(spark, f"{tmp_path}/{p.split('/')[0]}", p.split("/")[1], "json").collect()
    assert {(r.part, r.verdict, r.n) for r in read("report/summary") if r.level == "part and verdict"} == {("p", "match", 1), ("p", "known-divergence", 1), ("p", "presentation", 1)}
    assert {(r.level, r.n) for r in read("report/summary") if r.level in ("part", "overall")} == {("part", 3), ("overall", 3)}
    assert {r.ref for r in read("report/detail")} == {"A2", "A3"} and [(r.key, r.n) for r in read("report/reasons")] == [("left out", 1)]
    floor = verification.write_snapshot(good, f"{tmp_path}/snapshot", None)
    assert floor == verification.Floor(1, 2) and {(r.key, r.num, r.txt) for r in read("snapshot/values")} == {("p!s!A1", 1.0, None), ("p!s!A2", None, "x")}
    for bad, old in ((good.union(spark.createDataFrame([("p", "s", "A4", "error", *[None] * 5)], at)), None), (good, verification.Floor(1, 3))):
        with pytest.raises(ValueError):
            verification.write_snapshot(bad, f"{tmp_path}/refused", old)


def test_tables_written_inside_are_released(spark):
    from cellspark.sources import scratch

    with scratch.released(spark):
        df = scratch.written(spark.range(3), "some")
        path = df.inputFiles()[0]
        assert df.count() == 3
    assert not spark._jvm.java.io.File(path.removeprefix("file://").removeprefix("file:")).exists()


def test_stale_and_text_exemptions(spark):
    at = "part string, sheet string, ref string"
    r = spark.createDataFrame([("p", "s", "A1", "mismatch", None, "a", None, "b"), ("p", "s", "A2", "error", 1.0, None, 2.0, None), ("p", "s", "A3", "mismatch", 1.0, None, None, "b")], f"{at}, verdict string, e_num double, e_txt string, g_num double, g_txt string")
    x = spark.createDataFrame([("p", "s", "A1", None, "a", None, "b")] * 2 + [("p", "s", "A1", None, "a", None, "c"), ("p", "s", "A2", 1.0, None, 2.0, None), ("p", "s", "A3", 1.0, None, None, "c")], f"{at}, e_num double, e_txt string, g_num double, g_txt string")
    assert sorted((y.ref, y.verdict) for y in verification.exempt(r, x).collect()) == [("A1", "known-divergence"), ("A2", "error"), ("A3", "mismatch")]
    assert sorted((y.ref, y.reason) for y in verification.stale(x, r).collect()) == [("A1", "the computed value has changed"), ("A2", "it is no mismatch now"), ("A3", "the computed value has changed")]


def test_alignment_of_shuffled_rows_and_table_specs(spark):
    rng = __import__("random").Random(3)
    values = {(r, c): round(rng.uniform(1, 9e4), 2) for r in range(10, 18) for c in range(3, 8)}
    cells = spark.createDataFrame([("S", r, c, v) for (r, c), v in values.items()], "sheet string, r int, c int, num double")
    rows, cols = [12, 10, 17, 14, 11], [7, 4, 3]
    printed = [("T", i + 1, j + 1, float(math.floor(values[r, c] * 0.1 + 0.5)), 0) for i, r in enumerate(rows) for j, c in enumerate(cols)]
    printed[0] = (*printed[0][:3], -5.0, 0)  # one number that is nowhere
    got = publish.align(spark.createDataFrame(printed, "table string, i int, j int, value double, decimals int"), cells).first()
    assert (got.scale, got.pairs, got.matched, got.rate, got.status) == (0.1, 15, 14, 0.933, "ok")
    assert [(x.i, x.r) for x in got.rows] == list(enumerate(rows, 1)) and [(x.j, x.c) for x in got.cols] == list(enumerate(cols, 1))
    assert got.score == pytest.approx(14 / 15 * 100 + 14)  # neither rows nor columns ascend
    none = publish.align(spark.createDataFrame([("T", 1, 1, -1.0, 0)], "table string, i int, j int, value double, decimals int"), cells)
    assert none.count() == 0
