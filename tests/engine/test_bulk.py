"""Tables of criteria strings against the single predicates, running sums against plain windows, and what their plans look like."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellspark.functions import criteria as cr
from cellspark.operators import bulk, scans

TEXTS, NUMBERS = [None, "", "a", "A", "b", "12", "12x", "3.5", "x y", " 7 ", "  "], [None, 0.0, -0.0, 3.5, 7.0, 12.0, 100.0]
RAW = [None, "=", "<>", "", "a", "<>a", "=A", "12", "<>12", ">5", "<=7", "<12", ">=12x", "<b", ">a", "<>x y", "7", "<>7", "0", "<>0", " =x", ">=0", "<0"]
PREDICATES = {"text": lambda k: cr.on_long_text(F.col("t"), k), "number": lambda k: cr.on_long_number(F.col("n"), k), "grid": lambda k: cr.on_grid(F.col("gn"), F.col("gt"), k), "page": lambda k: cr.on_page(F.col("gn"), F.col("gt"), k)}


def field(kind):
    return {"text": lambda: bulk.Field("text", txt=F.col("t")), "number": lambda: bulk.Field("number", F.col("n")), "grid": lambda: bulk.Field("grid", F.col("gn"), F.col("gt")), "page": lambda: bulk.Field("page", F.col("gn"), F.col("gt"))}[kind]()


@pytest.fixture(scope="module")
def sample(spark):
    r = random.Random(2)
    rows = [(i, r.choice(TEXTS), r.choice(NUMBERS), r.choice(NUMBERS), r.choice(TEXTS), r.choice(NUMBERS)) for i in range(150)]
    rows = [(*x[:4], None if x[3] is not None else x[4], x[5]) for x in rows]
    facts = spark.createDataFrame(rows, "i int, t string, n double, gn double, gt string, v double")
    hits = facts.agg(*(F.collect_list(F.when(p(cr.split(raw)), F.col("i"))).alias(f"{k}|{raw}") for k, p in PREDICATES.items() for raw in RAW if raw is not None)).first().asDict()
    asked = [(i, *(r.choice(RAW) for _ in range(4))) for i in range(120)] + [(120, None, None, None, None)]
    return facts, {k: set(v) for k, v in hits.items()}, {x[0]: x[5] for x in rows}, asked


@pytest.mark.parametrize(("kinds", "how"), [(("text",), "sum"), (("number",), "count"), (("grid",), "mean"), (("page",), "count"), (("text", "number"), "sum"), (("number", "number"), "mean"), (("grid", "page"), "count"), (("text", "number", "grid"), "sum")])
def test_answers_equal_the_predicates(spark, sample, kinds, how):
    facts, hits, values, asked = sample
    names = "abcd"[: len(kinds)]
    questions = spark.createDataFrame(asked + [asked[3]], "qid int, a string, b string, c string, d string")  # one is asked twice
    got = {r.qid: r.value for r in bulk.answer(facts, questions, dict(zip(names, map({k: field(k) for k in kinds}.get, kinds))), F.col("v"), how).collect()}
    for qid, *raws in asked:
        ids = set(values)
        for raw, kind in zip(raws, kinds):
            ids &= ids if raw is None else hits[f"{kind}|{raw}"]
        found = [values[i] for i in ids if values[i] is not None]
        want = len(found) if how == "count" else sum(found) if how == "sum" else sum(found) / len(found) if found else None
        assert (got[qid] is None) == (want is None) and (want is None or abs(got[qid] - want) < 1e-9), (qid, raws)


def test_answers_over_nothing(spark, sample):
    facts, _, _, asked = sample
    questions = spark.createDataFrame(asked, "qid int, a string, b string, c string, d string")
    fields = {"a": field("text"), "b": field("number")}
    assert {r.value for r in bulk.answer(facts.limit(0), questions, fields, F.col("v")).collect()} == {0.0}
    assert bulk.answer(facts, questions.limit(0), fields, F.col("v")).collect() == []


@pytest.mark.parametrize("radix", [1, 3])
def test_compared_equals_a_loop(spark, monkeypatch, radix):
    monkeypatch.setattr(bulk, "BITS", radix)
    monkeypatch.setattr(bulk, "RADIX", 1 << radix)
    r = random.Random(radix)
    facts = [(r.choice("aAb"), r.choice([None, 1.0, 2.0, 2.5, 9.0, float("inf")]), r.choice([-1.0, 0.0, 3.0, None]), r.choice([1, 2, None])) for _ in range(200)]
    asked = [(i, r.choice(["a", "B", None]), *(r.choice([0.0, 1.0, 2.0, 5.0, -float("inf"), float("inf"), None]) for _ in range(3))) for i in range(60)]
    got = bulk.compared(spark.createDataFrame(facts, "k string, x double, y double, v int"), spark.createDataFrame(asked, "qid int, k string, lo double, hi double, top double"), {"k": "k"}, {"x": [(">=", "lo"), ("<", "hi")], "y": [("<=", "top")]}, F.col("v"))
    want = {i: sum(v or 0 for f, x, y, v in facts if None not in (lo, hi, top, x, y) and f.lower() == (k or "").lower() and lo <= x < hi and y <= top) for i, k, lo, hi, top in asked}
    assert {r.qid: r.value for r in got.collect()} == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_questions_with_bounds_have_no_nested_loop_and_no_single_partition(spark, monkeypatch):
    from cellspark.operators import aggregates

    monkeypatch.setattr(aggregates, "MOST_BROADCAST", 10)
    plans = []
    monkeypatch.setattr(scans, "written", lambda df, name, f=scans.written: (plans.append(plan(df)), f(df, name))[1])
    monkeypatch.setattr(bulk, "written", lambda df, name, f=bulk.written: (plans.append(plan(df)), f(df, name))[1])
    facts = spark.range(3000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 89).cast("double").alias("y"), F.lit(1).alias("v"))
    asked = spark.range(5000).select(F.col("id").alias("qid"), (F.col("id") % 50).cast("double").alias("lo"), (F.col("id") % 50 + 9).cast("double").alias("hi"), (F.col("id") % 70).cast("double").alias("top"))
    got = bulk.compared(facts, asked, {}, {"x": [(">=", "lo"), ("<", "hi")], "y": [("<=", "top")]}, F.col("v"), "count")
    plans.append(plan(got))
    assert len(plans) > 4 and not any(w in p for p in plans for w in ("NestedLoop", "CartesianProduct", "SinglePartition"))
    rows = facts.collect()
    some = {r.qid: r.value for r in got.filter("qid % 500 = 7").collect()}
    assert some == {q: sum(1 for f in rows if q % 50 <= f.x < q % 50 + 9 and f.y <= q % 70) for q in some} and len(some) == 10


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sums_equal_windows(spark, keys):
    r = random.Random(5)
    df = spark.createDataFrame([(r.choice([None, "a", "b"]), r.randint(0, 5), r.choice([None, 1, 2, 3])) for _ in range(300)], "k string, x int, v int").withColumn("i", F.monotonically_increasing_id()).cache()
    got = scans.running(df, keys, [(F.col("x"), True), (F.col("i"), False)], {"a": F.col("v"), "n": F.lit(1)}, 7)
    w = W.partitionBy(*keys).orderBy(F.desc("x"), "i").rowsBetween(W.unboundedPreceding, 0)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.withColumns({"a": F.sum("v").over(w), "n": F.sum(F.lit(1)).over(w)}).collect()))
    ranks = scans.ranked(df, "v", keys, parts=5)
    w = W.partitionBy(*keys, F.col("v").isNotNull()).orderBy(F.desc("v"))
    assert sorted(map(repr, ranks.collect())) == sorted(map(repr, df.withColumn("rank", F.when(F.col("v").isNotNull(), F.rank().over(w)).cast("long")).collect()))


def test_a_line_is_spread_over_partitions(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(scans, "written", lambda df, name, f=scans.written: kept.append(f(df, name)) or kept[-1])
    df = spark.range(4000).select(F.lit("one").alias("k"), F.lit(7).alias("x"), "id")  # one key, one value
    assert scans.running(df, ["k"], [(F.col("x"), False)], {"n": F.lit(1)}, 8).agg(F.max("n")).first()[0] == 4000
    sizes = [r["count"] for r in kept[0].groupBy("scan_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500


def test_bounds_lay_places_and_cuts_not_facts(spark, monkeypatch):
    """Rows between the same cuts are one: what is laid on lines grows with distinct places and cuts."""
    laid = []
    monkeypatch.setattr(bulk, "running", lambda df, *a, f=bulk.running: (laid.append(df.count()), f(df, *a))[1])
    facts = spark.range(6000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 61).cast("double").alias("y"), F.col("id").alias("v"))
    asked = [(1, 10.0, 20.0, 30.0), (2, 0.0, 50.0, 7.0), (3, 20.0, 10.0, 7.0)]
    got = bulk.compared(facts, spark.createDataFrame(asked, "qid int, lo double, hi double, top double"), {}, {"x": [(">=", "lo"), ("<", "hi")], "y": [("<=", "top")]}, F.col("v"))
    assert {r.qid: r.value for r in got.collect()} == {q: sum(i for i in range(6000) if lo <= i % 97 < hi and i % 61 <= top) for q, lo, hi, top in asked}
    assert max(laid) < 120
