"""Evaluating again what changed inputs move equals evaluating everything."""

import random

import pytest

from cellspark.plans import levels


@pytest.mark.parametrize("seed", [1, 2])
def test_reevaluation_equals_a_full_one(spark, seed):
    r = random.Random(seed)
    names = [f"c{i}" for i in range(30)]
    inputs = [(f"i{k}", float(k)) for k in range(6)]
    edges, specs = [], []
    for i, c in enumerate(names):
        specs.append((c, r.choice(["sum", "add", "max", "ref"])))
        pool = [x for x, _ in inputs] + names[:i] + (names if r.random() < 0.06 else [])
        edges += [(c, p, r.choice(pool)) for p in range(r.randint(1, 3))]
    s, e = spark.createDataFrame(specs, "cell string, shape string"), spark.createDataFrame(edges, "cell string, pos int, needs string")
    changed = [("i1", 50.0), ("i3", -7.0), ("new", 1.0)] + ([("c4", 9.0)] if seed == 2 else [])
    table = lambda x: spark.createDataFrame(x, "cell string, num double")
    before = levels.evaluate(table(inputs), s, e).cache()
    got = levels.reevaluate(before, table(changed), s, e).collect()
    after = levels.evaluate(table(list((dict(inputs) | dict(changed)).items())), s.filter(~s.cell.isin([c for c, _ in changed])), e).collect()
    assert {(x.cell, x.num, x.on_cycle) for x in got} == {(x.cell, x.num, x.on_cycle) for x in after} and len(got) == len(after)
    reach, step = set(), {c for c, _ in changed}
    while step:
        step = {c for c, _, n in edges if n in step and c not in reach and c not in dict(changed)}
        reach |= step
    assert {x.cell for x in got if x.touched} == reach | {c for c, _ in changed} and len(reach) < len(names)


def test_downstream_of_nothing_and_around_a_cycle(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("y", "x")], "cell string, needs string")
    at = lambda x: {r.cell for r in levels.downstream(e, spark.createDataFrame(x, "cell string")).collect()}
    assert at([("a",)]) == {"a", "b", "c", "d"} and at([("x",)]) == {"y"} and at([("none",)]) == set() == at([])


@pytest.mark.parametrize("seed", [3, 4])
def test_components_equal_mutual_reach(spark, seed):
    r = random.Random(seed)
    edges = list({(r.randint(0, 24), r.randint(0, 24)) for _ in range(26)} | {(90, 90), (91, 90), (90, 92), (92, 93), (93, 92), (95, 94)})
    reach = {c: {n for x, n in edges if x == c} for c in {c for e in edges for c in e}}
    for _ in reach:
        reach = {c: n | {z for y in n for z in reach[y]} for c, n in reach.items()}
    on = {c: min(n for n in reach[c] if c in reach[n]) for c in reach if c in reach[c]}
    want = {(c, on.get(c)) for c, n in reach.items() if c in on or n & set(on)}
    e = spark.createDataFrame(edges, "cell int, needs int")
    got = levels.cycles(e.select("cell").union(e.select("needs")), e).collect()
    assert {(x.cell, x.component) for x in got} == want and len(got) == len(want)
