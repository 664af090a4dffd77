"""Loads that lose no lines, stores that are replaced whole or not at all, windows that close, and functions that never raise."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellspark.functions import scalars as sc
from cellspark.plans import levels
from cellspark.sources import store, tables
from cellspark.streaming import refresh

GOOD = {"obs": '{"PRD_DE":"2024","DT":"1.5"}', "oecd": '{"REF_AREA":"KOR","value":"2"}', "grid": '{"r":1,"c":1,"v":1}'}
LOAD = {"obs": lambda s, p, **k: tables.load_obs(s, p, "x", **k), "oecd": tables.load_oecd, "grid": lambda s, p, **k: tables.load_grid(s, p, "x", **k)}


@pytest.mark.parametrize("kind", GOOD)
@pytest.mark.parametrize(("bad", "reason"), [("cut", "no JSON"), ("[1]", "no object"), ("12", "no object"), ('"text"', "no object")])
def test_a_damaged_line_is_never_lost(spark, tmp_path, kind, bad, reason):
    bad = GOOD[kind][:-4] if bad == "cut" else bad
    (tmp_path / "T.jsonl").write_text(f"{GOOD[kind]}\n\n  \n{bad}\n")
    with pytest.raises(PySparkException, match="damaged line"):
        LOAD[kind](spark, str(tmp_path)).collect()
    with pytest.raises(PySparkException, match="damaged line"):
        LOAD[kind](spark, str(tmp_path)).count()
    assert LOAD[kind](spark, str(tmp_path), skip_damaged=True).count() == 1
    (line,) = tables.damaged_lines(spark, str(tmp_path), kind).collect()
    assert (line.value, line.reason) == (bad, reason) and line.file.endswith("T.jsonl")


def test_kinds_of_cells(spark, tmp_path):
    values = [1, 2.5, -1e300, True, False, "true", "7", None, "", " ", [1, "a"], {"k": 1}]
    (tmp_path / "S.jsonl").write_text("".join(json.dumps({"r": i, "c": 1, "v": v}) + "\n" for i, v in enumerate(values)) + '{"r":99,"c":1}\n')
    got = {x.r: (x.v_num, x.v_txt) for x in tables.load_grid(spark, str(tmp_path), "e").collect()}
    assert got == {0: (1, None), 1: (2.5, None), 2: (-1e300, None), 3: (None, "true"), 4: (None, "false"), 5: (None, "true"), 6: (None, "7"), 10: (None, '[1,"a"]'), 11: (None, '{"k":1}')}
    (tmp_path / "T.jsonl").write_text('{"r":1,"v":1}\n')
    assert [x.reason for x in tables.damaged_lines(spark, str(tmp_path), "grid").collect()] == ["no place"]


def test_a_failed_load_leaves_the_former_tables(spark, tmp_path):
    root, folder = str(tmp_path / "store"), tmp_path / "in"
    folder.mkdir()
    (folder / "S.jsonl").write_text(GOOD["grid"] + "\n")
    assert store.current(spark, root) is None
    with pytest.raises(ValueError):
        store.table(spark, root, "grid")
    first = store.publish(spark, root, {"grid": tables.load_grid(spark, str(folder), "e"), "other": spark.range(3)})
    (folder / "S.jsonl").write_text(GOOD["grid"] + "\n{broken\n")
    with pytest.raises(PySparkException):
        store.publish(spark, root, {"other": spark.range(9), "grid": tables.load_grid(spark, str(folder), "e")})
    assert store.current(spark, root).endswith(first.rpartition("/")[2])
    assert (store.table(spark, root, "grid").count(), store.table(spark, root, "other").count()) == (1, 3)
    assert [x.name for x in (tmp_path / "store").iterdir() if x.is_dir()] == [first.rpartition("/")[2]]  # what was written of the other is gone
    tables.write_parts(spark.range(4).withColumn("part", F.col("id") % 2), root, "parts", "part")
    assert (store.table(spark, root, "grid").count(), store.table(spark, root, "parts").filter("part = 1").count()) == (1, 2)
    store.clear(spark, root)
    assert store.table(spark, root, "other").count() == 3 and sum(x.is_dir() for x in (tmp_path / "store").iterdir()) == 1
    tables.write_documents(spark.range(2), str(tmp_path / "docs"), "d")
    assert store.table(spark, str(tmp_path / "docs"), "d", "json").count() == 2


def test_late_rows_stay_out_of_closed_windows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda *x: spark.createDataFrame(x, "k string, at string, v double").withColumn("at", F.to_timestamp("at"))

    def run(df):
        df.write.mode("append").parquet(src)
        totals = refresh.running_totals(refresh.arriving(spark, src, df.schema, 1), ["k"], "v", "at", "1 day", "1 day")
        refresh.refresh(totals, out, str(tmp_path / "cp"), windows=True).awaitTermination(120)

    run(rows(("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-01 12:00:00", 2.0)).coalesce(1))
    run(rows(("a", "2024-01-20 00:00:00", 5.0)).coalesce(1))
    run(rows(("a", "2024-01-01 11:00:00", 100.0), ("a", "2024-01-25 00:00:00", 7.0)).coalesce(1))
    run(rows(("a", "2024-02-25 00:00:00", 9.0)).coalesce(1))
    got = {(str(r.window.start)[:10], r.total) for r in spark.read.parquet(out).collect()}
    assert {x for x in got if x[0] < "2024-01-24"} == {("2024-01-01", 3.0), ("2024-01-20", 5.0)}


VALUES = [0.0, -0.0, 1.0, -1.0, 2.5, 1e10, -1e10, 1e308, -1e308, float("inf"), -float("inf"), float("nan"), None]


def test_functions_raise_for_no_pair_of_numbers(spark):
    pairs = spark.createDataFrame([(a, b) for a in VALUES for b in VALUES], "a double, b double")
    a, b, s = F.col("a"), F.col("b"), F.lit("text")
    every = {
        "left": sc.left(s, b), "right": sc.right(s, b), "round": sc.round_half_away(a, b), "text": sc.text_fixed(a, b), "div": sc.divide(a, b), "quotient": sc.quotient(a, b), "mod": sc.modulo(a, b), "percent": sc.percent(a),
        "floor": sc.floor(a), "digits": sc.fifteen_digits(a), "general": sc.general_number(a), "up": sc.round_half_up(a, 2), "same": sc.same_value(sc.cell(a), sc.cell(b)), "less": sc.compare(sc.cell(a), "<", sc.cell(b)),
        "equal": sc.compare(sc.cell(a), "=", sc.cell(b)), "dash": sc.general_text(sc.zero_dash(sc.cell(a))), "concat": sc.concat(sc.cell(a), sc.cell(b)),
    }
    args = F.array(sc.cell(a), sc.cell(b), sc.cell(a))
    every |= {f"shape {k}": sc.general_text(f(args)) for k, f in levels.SHAPES.items()}
    rows = {(repr(r.a), repr(r.b)): r for r in pairs.select("a", "b", *(c.alias(k) for k, c in every.items())).collect()}
    at = lambda x, y: rows[repr(x), repr(y)]
    assert (at(0.0, 1e10).left, at(0.0, 1e10).right, at(0.0, -1e10).left, at(0.0, float("inf")).left, at(0.0, float("nan")).right) == ("text", "text", None, "text", None)
    assert (at(2.5, 0.0)["round"], at(2.5, 1e10)["round"], at(2.5, -1e10)["round"], at(1e308, 1e308)["round"]) == (3.0, 2.5, 0.0, 1e308)
    assert (at(2.5, 0.0).text, at(2.5, 1.0).text, at(2.5, 1e10).text, at(2.5, float("nan")).text) == ("3", "2.5", None, None)


def test_one_bad_operand_does_not_end_an_evaluation(spark):
    inputs = spark.createDataFrame([("x", 2.5), ("n", 1e10)], "cell string, num double")
    specs = spark.createDataFrame([("t", "text"), ("s", "sum")], "cell string, shape string")
    edges = spark.createDataFrame([("t", 0, "x"), ("t", 1, "n"), ("s", 0, "x")], "cell string, pos int, needs string")
    got = {r.cell: (r.num, r.txt) for r in levels.evaluate(inputs, specs, edges).collect()}
    assert got["t"] == (None, None) and got["s"] == (2.5, None)
