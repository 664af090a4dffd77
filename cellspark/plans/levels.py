"""Cells that depend on cells: levels, transitive leaves, and evaluation as soon as all operands are there.

The dependency graph is a table of edges(cell, needs). Each round is one
distributed join, written to the folder that all executors share; there is no
bound on the rounds. Levels and leaves shorten paths by half in each round, so
that a chain of n cells takes about log n rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..sources.scratch import Growing, written


def levels(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """cell, level: 0 for cells without needs, else one more than the highest need; cells on or behind a cycle have none.

    A row says that a cell lies `dist` above an unsettled need, or (without one)
    at least at `base`. In each round, needs that are settled turn into bases, and
    needs that wait for a single cell themselves are replaced by that one.
    """
    all_cells = cells.select("cell").distinct()
    rows = edges.select("cell", "needs", F.lit(1).alias("dist"), F.lit(None).cast("int").alias("base")).distinct()
    rows = rows.unionByName(all_cells.select("cell", F.lit(None).cast(edges.schema["needs"].dataType).alias("needs"), F.lit(None).cast("int").alias("dist"), F.lit(0).alias("base")))
    rows, before, edges_before = written(rows, "levels"), None, None
    while True:
        by_cell = rows.groupBy("cell").agg(F.count("needs").alias("open"), F.max("base").alias("own"), F.max("needs").alias("next"), F.max("dist").alias("more"))
        known = by_cell.filter((F.col("open") == 0) & F.col("own").isNotNull() | (F.col("open") == 1) & (F.col("next") != F.col("cell"))).withColumnRenamed("cell", "needs")
        met = rows.join(known, "needs", "left")
        base = F.greatest("base", F.col("dist") + F.col("own"))
        step = met.select("cell", F.when(F.col("open").isNull(), F.col("needs")).otherwise(F.col("next")).alias("needs"), F.when(F.col("open").isNull(), F.col("dist")).otherwise(F.col("dist") + F.col("more")).alias("dist"), base.alias("base"))
        settled = Observation()
        step = step.groupBy("cell", "needs").agg(F.max("dist").alias("dist"), F.max("base").alias("base"))
        # A base that comes with an edge is a row of its own: it must not wait for the edge.
        step = step.select("cell", F.inline(F.array(F.struct("needs", "dist", F.when(F.col("needs").isNull(), F.col("base")).alias("base")), F.struct(F.lit(None).cast(edges.schema["needs"].dataType).alias("needs"), F.lit(None).cast("int").alias("dist"), F.coalesce("base", F.lit(0)).alias("base")))))
        rows = written(step.distinct().observe(settled, F.count("needs").alias("edges")), "levels")
        n = settled.get["edges"]
        if not n:
            break
        if edges_before is not None and n >= edges_before:
            # Without a cycle, some cell waits for settled ones only: there are fewer that wait than when this was last looked at.
            waiting = rows.filter("needs is not null").select("cell").distinct().count()
            if waiting == before:
                break
            before = waiting
        edges_before = n
    done = rows.groupBy("cell").agg(F.when(F.count("needs") == 0, F.max("base")).alias("level"))
    return all_cells.join(done, "cell", "left")


def _least_below(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels(cell, label), each lowered to the least label of all that the cell needs over any number of steps."""
    state = new = written(labels, "labels")
    while True:
        offered = edges.join(new.withColumnRenamed("cell", "needs"), "needs").groupBy("cell").agg(F.min("label").alias("offer"))
        lower = written(offered.join(state, "cell").filter("offer < label").select("cell", F.col("offer").alias("label")), "labels")
        if lower.isEmpty():
            return state
        better = lower.withColumnRenamed("label", "offer")
        state = written(state.join(better, "cell", "left").select("cell", F.coalesce("offer", "label").alias("label")), "labels")
        new = lower  # only what has changed can lower others


def cycles(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """cell, component of the cells that levels() leaves without a level: those of one cycle (or of cycles that meet) share
    a component, named by its smallest cell; those that merely wait behind a cycle, or lie between two, have none.

    Cells that nothing on a cycle needs are trimmed by levels along the reversed edges. Of the
    others, each takes the smallest cell that it needs over any number of steps; where that is the cell itself,
    it and all that it needs with the same smallest cell are one component. Components are taken away
    until nothing is left. Rounds are as many as a cycle is long.
    """
    waiting = written(levels(cells, edges).filter("level is null").select("cell"), "waiting")
    inside = lambda e, c: e.join(c, "cell", "left_semi").join(c.withColumnRenamed("cell", "needs"), "needs", "left_semi").select("cell", "needs").distinct()
    graph = written(inside(edges, waiting), "graph")
    back = levels(waiting, graph.select(F.col("needs").alias("cell"), F.col("cell").alias("needs")))
    left = written(back.filter("level is null").select("cell"), "left")
    graph, found = written(inside(graph, left), "graph"), Growing("components")
    found.add(left.limit(0).select("cell", F.col("cell").alias("component")))
    while not left.isEmpty():
        label = _least_below(left.select("cell", F.col("cell").alias("label")), graph)
        a, b = label.select("cell", F.col("label").alias("mine")), label.select(F.col("cell").alias("needs"), F.col("label").alias("its"))
        same = graph.join(a, "cell").join(b, "needs").filter("mine = its")
        roots = label.filter("cell = label").select("cell")
        reached = downstream(same.select(F.col("needs").alias("cell"), F.col("cell").alias("needs")), roots)
        # A cell by itself is on a cycle if it needs itself: then it is reached from itself, too.
        found.add(label.join(reached, "cell", "left_semi").select("cell", F.col("label").alias("component")))
        gone = reached.union(roots).distinct()
        left = written(left.join(gone, "cell", "left_anti"), "left")
        graph = written(inside(graph, left), "graph")
    return waiting.join(found.all(), "cell", "left")


def leaves(edges: DataFrame) -> DataFrame:
    """cell, leaf: the cells without needs that each cell rests on, over any number of steps.

    Each cell's ends are replaced by these ends' own ends, until all are leaves:
    paths double in each round, and cells in between never become rows of the
    result. Around a cycle ends remain that are no leaves; they go when paths are
    longer than there are cells.
    """
    ends = written(edges.select("cell", F.col("needs").alias("leaf")).distinct(), "leaves")
    inner = written(ends.select("cell").distinct(), "inner").withColumnRenamed("cell", "leaf")
    most, reached = inner.count(), 1
    ends = written(ends.join(inner.withColumn("open", F.lit(True)), "leaf", "left").select("cell", "leaf", F.coalesce("open", F.lit(False)).alias("open")), "leaves")
    while reached <= most and not ends.filter("open").isEmpty():
        through = ends.filter("open").select("cell", F.col("leaf").alias("via")).join(ends.select(F.col("cell").alias("via"), "leaf", "open"), "via").select("cell", "leaf", "open")
        ends = written(ends.filter("not open").select("cell", "leaf", "open").union(through).distinct(), "leaves")
        reached *= 2
    return ends.filter("not open").select("cell", "leaf")


#: What a cell may do with its operands, ordered by position: name -> cell value from `args`, an array of cell values.
SHAPES: dict[str, Callable[[Column], Column]] = {}


def shape(name: str) -> Callable:
    def add(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
        SHAPES[name] = f
        return f

    return add


def _at(a: Column, i: int) -> Column:
    return F.get(a, F.lit(i))


def _number(a: Column, i: int) -> Column:
    return sc.operand(_at(a, i))


def _numbers(a: Column) -> Column:
    """The numbers of a range: texts and blanks are left out."""
    return F.filter(F.transform(a, lambda x: x["num"]), lambda x: x.isNotNull())


shape("ref")(lambda a: _at(a, 0))
shape("sum")(lambda a: sc.cell(F.aggregate(_numbers(a), F.lit(0.0), lambda x, y: x + y)))
shape("add")(lambda a: sc.cell(F.aggregate(a, F.lit(0.0), lambda x, y: x + sc.operand(y))))
shape("sub")(lambda a: sc.cell(_number(a, 0) - _number(a, 1)))
shape("mul")(lambda a: sc.cell(_number(a, 0) * _number(a, 1)))
shape("div")(lambda a: sc.cell(sc.divide(_number(a, 0), _number(a, 1))))
shape("pct_of")(lambda a: sc.cell(sc.divide(_number(a, 0), _number(a, 1) / 100.0)))
shape("quotient")(lambda a: sc.cell(sc.quotient(_number(a, 0), _number(a, 1))))
shape("mod")(lambda a: sc.cell(sc.modulo(_number(a, 0), _number(a, 1))))
shape("max")(lambda a: sc.cell(F.coalesce(F.array_max(_numbers(a)), F.lit(0.0))))
shape("counta")(lambda a: sc.cell(F.size(F.filter(a, lambda x: x["num"].isNotNull() | (x["txt"] != "")))))
shape("if")(lambda a: sc.if_else(_at(a, 0), _at(a, 1), _at(a, 2)))
shape("iferror")(lambda a: F.when(sc.is_blank(_at(a, 0)), _at(a, 1)).otherwise(_at(a, 0)))
shape("concat")(lambda a: sc.cell(txt=F.aggregate(a, F.lit(""), lambda x, y: F.concat(x, sc.general_text(y)))))
shape("round")(lambda a: sc.cell(sc.round_half_away(_number(a, 0), _number(a, 1))))
shape("text")(lambda a: sc.cell(txt=sc.text_fixed(_at(a, 0)["num"], _number(a, 1))))
shape("zero_dash")(lambda a: sc.zero_dash(_at(a, 0)))
for _relation in ("=", "<>", "<", "<=", ">", ">="):
    shape(f"cmp {_relation}")(lambda a, r=_relation: sc.cell(sc.compare(_at(a, 0), r, _at(a, 1))))


def evaluate(inputs: DataFrame, specs: DataFrame, edges: DataFrame) -> DataFrame:
    """cell, num, txt, on_cycle of inputs(cell, num, optionally txt) and of all specs(cell, shape) over edges(cell, pos, needs).

    In each round the cells are evaluated whose last operand came with the round
    before: one job, whatever their shapes, since a shape is a branch over the array
    of operands. Operands in unknown cells are blank; a cell that is given as an
    input and specified, too, keeps its input. Cells on or behind a cycle
    come back without a value, and say so.
    """
    txt = F.col("txt") if "txt" in inputs.columns else F.lit(None).cast("string")
    inputs = inputs.select("cell", F.col("num").cast("double").alias("num"), txt.alias("txt"))
    specs = specs.join(inputs.select("cell"), "cell", "left_anti")
    cells = specs.select("cell").union(inputs.select("cell")).distinct().select(F.col("cell").alias("needs"), F.lit(True).alias("inside"))
    operands = specs.select("cell", "shape").distinct().join(edges.select("cell", "pos", "needs"), "cell", "left").join(cells, "needs", "left")
    operands = written(operands.select("cell", "shape", "pos", "needs", F.coalesce("inside", F.lit(False)).alias("inside")), "operands")
    asked = operands.agg(F.count_distinct("cell").alias("cells"), F.collect_set("shape").alias("shapes")).first()  # one row; no more shapes than there are
    left, value = asked["cells"], sc.cell()
    for name in SHAPES.keys() & set(asked["shapes"]):
        value = F.when(F.col("shape") == name, SHAPES[name](F.col("args"))).otherwise(value)

    def evaluated(met: DataFrame) -> DataFrame:
        """Of operands with num, txt and arrived (for all of a cell's): the cells that wait for none."""
        args = F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.struct("num", "txt").alias("v"))))
        whole = met.groupBy("cell", "shape").agg(F.bool_and(F.col("arrived") | ~F.col("inside")).alias("ready"), F.transform(F.array_sort(args), lambda x: x["v"]).alias("args"))
        return whole.filter("ready").select("cell", value.alias("v")).select("cell", "v.num", "v.txt")

    known = Growing("values")
    blank = [F.lit(None).cast(t).alias(n) for t, n in (("double", "num"), ("string", "txt"))]
    free = operands.join(operands.filter("inside").select("cell").distinct(), "cell", "left_anti").withColumns({"num": blank[0], "txt": blank[1], "arrived": F.lit(False)})
    known.add(inputs)
    _, n = known.counted(evaluated(free))
    left, new, n = left - n, known.all(), 1
    while left and n:
        # Only cells that need one of the last round's can be next.
        near = operands.join(new.select(F.col("cell").alias("needs")), "needs", "left_semi").select("cell").distinct()
        met = operands.join(near, "cell", "left_semi").join(known.all().select(F.col("cell").alias("needs"), "num", "txt", F.lit(True).alias("here")), "needs", "left")
        new, n = known.counted(evaluated(met.withColumn("arrived", F.coalesce("here", F.lit(False)))))
        left -= n
    out = known.all().withColumn("on_cycle", F.lit(False))
    if not left:
        return out
    behind = specs.select("cell").distinct().join(known.all().select("cell"), "cell", "left_anti")
    return out.unionByName(behind.select("cell", *blank, F.lit(True).alias("on_cycle")))


def downstream(edges: DataFrame, start: DataFrame) -> DataFrame:
    """cell: everything that needs a cell of start(cell), over any number of steps; start's own cells only if they lie on a cycle."""
    found = Growing("downstream")
    back = written(edges.select("cell", "needs").distinct(), "edges")
    new, n = found.counted(back.join(start.select(F.col("cell").alias("needs")).distinct(), "needs", "left_semi").select("cell").distinct())
    while n:
        # Only what the last round found can lead further; what is known isn't found again.
        step = back.join(new.withColumnRenamed("cell", "needs"), "needs", "left_semi").select("cell").distinct()
        new, n = found.counted(step.join(found.all(), "cell", "left_anti"))
    return found.all()


def reevaluate(values: DataFrame, changed: DataFrame, specs: DataFrame, edges: DataFrame) -> DataFrame:
    """cell, num, txt, on_cycle, touched: what evaluate() gives once the inputs changed(cell, num, optionally txt) have their new values.

    values: what evaluate() gave before. Only cells downstream of the changed inputs are
    evaluated again, from the stored values of all others; touched marks these and
    the inputs. A changed cell need not have existed; one that is specified becomes an input.
    """
    txt = F.col("txt") if "txt" in changed.columns else F.lit(None).cast("string")
    changed = written(changed.select("cell", F.col("num").cast("double").alias("num"), txt.alias("txt")), "changed")
    own = changed.select("cell")
    specs = specs.join(own, "cell", "left_anti")
    edges = edges.join(specs.select("cell"), "cell", "left_semi")
    moved = written(downstream(edges, own), "moved")
    mine = specs.join(moved, "cell", "left_semi")
    operands = edges.join(moved, "cell", "left_semi")
    touched = moved.union(own).distinct()
    kept = values.join(touched, "cell", "left_anti")
    near = written(kept.join(operands.select(F.col("needs").alias("cell")).distinct(), "cell", "left_semi"), "near")
    # A stored cell without a value, as it waits for a cycle, waits for itself here.
    stuck = near.filter("on_cycle").select("cell")
    mine = mine.select("cell", "shape").union(stuck.select("cell", F.lit("ref")))
    operands = operands.select("cell", "pos", "needs").union(stuck.select("cell", F.lit(0), "cell"))
    inputs = near.filter("not on_cycle").select("cell", "num", "txt").union(changed)
    new = evaluate(inputs, mine, operands).join(touched, "cell", "left_semi")
    mark = lambda df, t: df.select("cell", "num", "txt", "on_cycle", F.lit(t).alias("touched"))
    return mark(kept, False).union(mark(new, True))
