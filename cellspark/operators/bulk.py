"""Tables of conditional sums whose criteria are strings of any kind: equal, unequal, blank, and bounds on several columns.

Each question row holds a criterion string per column (">=25", "<>x", "=", "x";
null: none). Nothing is compared row by row:

* Criteria other than equality become signed ones. "<>x" is all rows that may
  count, less those that are equal; a blank or an equal cell is a key. So every question
  is a signed sum of questions of the kind "these columns equal these keys", which
  an equi join answers for all patterns of columns at once.
* Bounds are cuts of an ordered column: rows before the upper cut, less rows
  before the lower one. The distinct cuts of a column are numbered, and of a row
  nothing matters but how many cuts lie before it: rows between the same cuts are
  summed up first. Rows before the cuts of several columns are counted
  without comparing questions and rows: all columns but the one with most cuts are divided
  into blocks of RADIX**level neighbouring numbers, a cut takes some blocks of each
  level, and within each block a running sum along the last column answers. A
  question without a bound on a column meets sums over that whole column.

A table of N rows with d bounded columns becomes N * log(C)**(d - 1) rows (base RADIX; C: distinct cuts of a column)
at most before these are summed up; a question with as many bounds grows likewise. Sums of decimals are exact; sums of
doubles are rounded as sums and differences of doubles are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.criteria import split_column
from ..functions.scalars import NUMBER, ascii_fold, fifteen_digits, number_prefix, text_number
from ..sources.scratch import written
from . import aggregates
from .aggregates import small
from .scans import running

#: Blocks per block of the next level.
RADIX = 8
BITS = RADIX.bit_length() - 1

INF = float("inf")
CUT = "struct<kind:int,num:double,txt:string,after:int>"
CHOICE = "array<struct<sign:int,mask:int,key:string>>"


def cut(kind: int, num: Column | None = None, txt: Column | None = None, after: int = 0) -> Column:
    """A place in a column's order (numbers, then texts, then blanks): before or after all cells of one value."""
    number = F.lit(0.0) if num is None else F.coalesce(num.cast("double") + 0.0, F.lit(0.0))
    return F.struct(F.lit(kind).alias("kind"), number.alias("num"), (F.lit("") if txt is None else F.coalesce(txt, F.lit(""))).alias("txt"), F.lit(after).alias("after"))


@dataclass(frozen=True)
class Field:
    """A criterion column of facts: how its cells are told apart, where they lie in order, and what criteria mean on it.

    kind "text": a text column of a long table; "number": a number column of one;
    "grid": a cell of a sparse grid; "page": a cell of a page. num and txt: the cell.
    """

    kind: str
    num: Column | None = None
    txt: Column | None = None

    def key(self) -> Column:
        """What equal cells share; null for a cell that no equality meets."""
        if self.kind == "text":
            return ascii_fold(self.txt)
        if self.kind == "number":
            return (self.num + 0.0).cast("string")
        if self.kind == "grid":
            return F.coalesce(F.concat(F.lit("n"), (self.num + 0.0).cast("string")), F.concat(F.lit("t"), ascii_fold(self.txt)))
        return F.coalesce(F.concat(F.lit("n"), (self.page_number() + 0.0).cast("string")), F.concat(F.lit("t"), F.upper(F.trim(self.txt))))

    def page_number(self) -> Column:
        """The number of a page's cell: texts but the empty one count as what they spell."""
        return fifteen_digits(F.coalesce(self.num, F.when(self.txt != "", text_number(self.txt))))

    def present(self) -> Column:
        """Whether there is a cell; on pages, one that isn't the empty text."""
        there = reduce(Column.__or__, [c.isNotNull() for c in (self.num, self.txt) if c is not None])
        return (self.num.isNotNull() | F.coalesce(self.txt != "", F.lit(False))) if self.kind == "page" else there

    def places(self) -> Column:
        """Where a cell lies in the column's order: array of cuts. Texts on long tables and pages lie among the numbers, by the one they begin with or spell, and among the texts; on pages, every row has a further place behind them."""
        end = F.array(cut(2, None, None, 1))
        if self.kind == "text":
            return F.when(self.txt.isNotNull(), F.array(cut(0, number_prefix(self.txt), None, 1), cut(1, None, ascii_fold(self.txt), 1))).otherwise(end)
        if self.kind == "number":
            return F.when(self.num.isNotNull(), F.array(cut(0, self.num, None, 1))).otherwise(end)
        if self.kind == "grid":
            return F.when(self.num.isNotNull(), F.array(cut(0, self.num, None, 1))).when(self.txt.isNotNull(), F.array(cut(1, None, ascii_fold(self.txt), 1))).otherwise(end)
        number = self.page_number()
        return F.array_compact(F.concat(F.array(F.when(number.isNotNull(), cut(0, number, None, 1)), F.when(self.txt.isNotNull(), cut(1, None, F.upper(F.trim(self.txt)), 1))), end))

    def choices(self, raw: Column) -> Column:
        """array<struct<sign, mask, key>>: the signed equalities that a criterion is; mask 0: any row, 1: present ones, 2: those with the key."""
        k = split_column(raw)
        op, rhs = k["op"], k["rhs"]
        number = F.when(rhs.rlike(NUMBER), rhs.try_cast("double"))
        one = lambda sign, mask, key=None: F.struct(F.lit(sign).alias("sign"), F.lit(mask).alias("mask"), (F.lit(None) if key is None else key).cast("string").alias("key"))
        if self.kind == "number":
            same, any_row = F.when(number.isNotNull(), F.array(one(1, 2, (number + 0.0).cast("string")))), one(1, 1)
        elif self.kind == "text":
            same, any_row = F.array(one(1, 2, ascii_fold(rhs))), one(1, 1)
        elif self.kind == "grid":
            text, num = one(1, 2, F.concat(F.lit("t"), ascii_fold(rhs))), one(1, 2, F.concat(F.lit("n"), (number + 0.0).cast("string")))
            same, any_row = F.when(number.isNotNull(), F.array(text, num)).otherwise(F.array(text)), one(1, 0)
        else:
            same, any_row = F.array(one(1, 2, F.when(number.isNotNull(), F.concat(F.lit("n"), (fifteen_digits(number) + 0.0).cast("string"))).otherwise(F.concat(F.lit("t"), F.upper(F.trim(rhs)))))), one(1, 0)
        same = F.coalesce(same, F.array().cast(CHOICE))
        less = F.transform(same, lambda s: F.struct((-s["sign"]).alias("sign"), s["mask"].alias("mask"), s["key"].alias("key")))
        out = F.when(raw.isNull(), F.array(one(1, 0)))
        if self.kind in ("grid", "page"):
            out = out.when((rhs == "") & (op == "<>"), F.array(one(1, 1))).when((rhs == "") & (op == "="), F.array(one(1, 0), one(-1, 1)))
        if self.kind == "number":
            # Numbers come before all texts.
            out = out.when(number.isNull() & op.isin("<>", "<", "<="), F.array(one(1, 1))).when(number.isNull(), F.array().cast(CHOICE))
        return out.when(op == "=", same).when(op == "<>", F.concat(F.array(any_row), less)).otherwise(F.array(one(1, 0))).cast(CHOICE)

    def compared(self, raw: Column) -> Column:
        """Whether a criterion is a bound."""
        k = split_column(raw)
        bound = raw.isNotNull() & k["op"].isin("<", "<=", ">", ">=")
        return bound & k["rhs"].rlike(NUMBER) if self.kind == "number" else bound

    def interval(self, raw: Column) -> Column:
        """struct<lo, hi>: the cuts between which a bound's cells lie; null for other criteria."""
        k = split_column(raw)
        op, rhs = k["op"], k["rhs"]
        number = F.when(rhs.rlike(NUMBER), rhs.try_cast("double"))
        number = fifteen_digits(number) if self.kind == "page" else number
        text = F.upper(F.trim(rhs)) if self.kind == "page" else ascii_fold(rhs)
        at = lambda after: F.when(number.isNotNull(), cut(0, number, None, after)).otherwise(cut(1, None, text, after))
        first = F.when(number.isNotNull(), cut(0, F.lit(-INF))).otherwise(cut(1))
        last = F.when(number.isNotNull(), cut(1)).otherwise(cut(2))
        lo = F.when(op == ">", at(2)).when(op == ">=", at(0)).otherwise(first)
        hi = F.when(op == "<", at(0)).when(op == "<=", at(2)).otherwise(last)
        return F.when(self.compared(raw), F.struct(lo.alias("lo"), hi.alias("hi")))

    def lowest(self) -> int:
        """The kind of places from which on each row has exactly one."""
        return {"text": 1, "page": 2}.get(self.kind, 0)

    def between(self, raws: list[Column]) -> Column:
        """struct<lo, hi>: where all bounds meet, null without a bound."""
        bounds = F.array_compact(F.array(*map(self.interval, raws)))
        return F.when(F.size(bounds) > 0, F.struct(F.array_max(F.transform(bounds, lambda b: b["lo"])).alias("lo"), F.array_min(F.transform(bounds, lambda b: b["hi"])).alias("hi")))


def cuts_of(between: Column) -> Column:
    """array<struct<sign, cut>>: rows before the upper cut, less rows before the lower one; without a bound a null cut."""
    signed = lambda sign, c: F.struct(F.lit(sign).alias("sign"), c.cast(CUT).alias("cut"))
    lo, hi = between["lo"], between["hi"]
    start = (lo["kind"] == 0) & (lo["num"] == -INF) & (lo["after"] == 0)  # nothing lies before it
    some = F.when(start, F.array(signed(1, hi))).otherwise(F.array(signed(1, hi), signed(-1, lo)))
    return F.when(between.isNull(), F.array(signed(1, F.lit(None)))).when(lo < hi, some).otherwise(F.array().cast(f"array<struct<sign:int,cut:{CUT}>>"))


def levels_for(n: int) -> int:
    """Levels of blocks, so that a block of the level above the highest would hold n numbers."""
    out = 1
    while n >> (BITS * out):
        out += 1
    return out


def numbered(facts: DataFrame, asked: DataFrame, column: str) -> tuple[DataFrame, DataFrame, int]:
    """The places of facts and the cuts of asked, each (at) with the number (n) of distinct cuts up to it; how many cuts there are."""
    places = facts.select(F.col(column).alias("at"), F.lit(None).cast("int").alias("cut")).distinct()
    cuts = asked.filter(F.col(column).isNotNull()).select(F.col(column).alias("at"), F.lit(1).alias("cut")).distinct()
    got = running(places.unionByName(cuts), [], [(F.col("at"), False)], {"n": F.col("cut")})
    got = written(got.select("at", "cut", F.coalesce("n", F.lit(0)).cast("long").alias("n")), "numbers")
    places, cuts = got.filter("cut is null").select("at", "n"), got.filter("cut is not null").select("at", "n")
    return places, cuts, cuts.agg(F.max("n")).first()[0] or 0


def _replaced(df: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    """df with column's place or cut replaced by its number; null stays null."""
    numbers = small(numbers.select(F.col("at").alias("_at"), F.col("n").alias("_n")))
    return df.join(numbers, F.col(column) == F.col("_at"), "left").drop(column, "_at").withColumnRenamed("_n", column)


def _asked_for(facts: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """The facts with keys that some question has."""
    used = small(asked.select(*(F.col(k).alias(f"used_{k}") for k in keys)).distinct())
    return facts.join(used, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"used_{k}")) for k in keys], F.lit(True)), "left_semi")


def _blocks(n: Column, i: int, highest: bool, level: str, block: str) -> Column:
    """The blocks of level i that the numbers below n take: as many as the digit of n there says, before the ones of lower levels."""
    upto = F.shiftright(n, BITS * i)
    count = upto if highest else upto.bitwiseAND(RADIX - 1)
    all_of = F.when(count > 0, F.sequence(upto - count, upto - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(all_of, lambda b: F.struct(F.lit(i).alias(level), b.alias(block)))


def before_cuts(facts: DataFrame, asked: DataFrame, keys: list[str], columns: dict[str, int], values: list[str], qid: str) -> DataFrame:
    """qid and signed sums of values over the facts that share a question's keys and whose number is below its own in every column.

    facts(keys, columns, values) and asked(keys, columns, qid, sign), with numbers as
    numbered() gives them; null on both sides: no bound. columns: name -> how many cuts it has.
    """
    *first, last = sorted(columns, key=columns.get)
    for c in first:
        top = levels_for(columns[c])
        at, level, block = F.col(c), f"{c}_level", f"{c}_block"
        all_rows = F.array(F.struct(F.lit(-1).alias(level), F.lit(0).cast("long").alias(block)))
        own = F.array(*(F.struct(F.lit(i).alias(level), F.shiftright(at, BITS * i).alias(block)) for i in range(top)))
        facts = facts.select("*", F.inline(F.when(at.isNull(), all_rows).otherwise(own))).drop(c)
        # A cut takes, of each level, the blocks that its digit there counts.
        taken = F.flatten(F.array(*(_blocks(at, i, i == top - 1, level, block) for i in range(top))))
        asked = asked.select("*", F.inline(F.when(at.isNull(), all_rows).otherwise(taken))).drop(c)
        keys = [*keys, level, block]
        facts = _asked_for(facts, asked, keys)
    # A question comes before the facts that have its own number; without a bound, behind all.
    facts, asked = facts.withColumn(last, F.coalesce(last, F.lit(0))), asked.withColumn(last, F.coalesce(last, F.lit(1)))
    summed = facts.groupBy(*keys, last).agg(*(F.sum(v).alias(v) for v in values))
    none = {c: F.lit(None).cast(t) for c, t in asked.select(qid, "sign").dtypes}
    line = summed.select(*keys, last, *values, *(none[c].alias(c) for c in (qid, "sign"))).unionByName(asked.select(*keys, last, qid, "sign"), allowMissingColumns=True)
    got = running(line, keys, [(F.col(last), False), (F.col("sign").isNull(), False)], {f"_{v}": F.col(v) for v in values}).filter(F.col("sign").isNotNull())
    return got.groupBy(qid).agg(*(F.sum(F.when(F.col("sign") > 0, F.col(f"_{v}")).otherwise(-F.col(f"_{v}"))).alias(v) for v in values))


def answer(facts: DataFrame, questions: DataFrame, fields: dict[str, Field], value: Column, how: str = "sum", keys: dict[str, str] | None = None, empty: float | int | None = 0, qid: str = "qid") -> DataFrame:
    """qid, value for each row of questions(qid, a criterion column per field, keys).

    fields: question column -> what it is compared with; keys: fact column -> question
    column, equal as they are (null meets null). how: "sum", "count" (rows with a value) or "mean".
    empty: the value of a question that no row meets (a mean over nothing is null).
    A question is asked once, however often its row occurs.
    """
    keys = keys or {}
    raws = list(fields)
    once = questions.select(*raws, *keys.values()).distinct().repartition(questions.sparkSession.sparkContext.defaultParallelism)
    once = written(once.withColumn("_q", F.monotonically_increasing_id()), "questions")
    shapes = once.agg(*(F.bool_or(f.compared(F.col(r))).alias(r) for r, f in fields.items())).first()  # one row
    # Bounds of one field meet in one interval; texts may have two orders, so that each of their bounds stands alone.
    bounded: dict[tuple, tuple[Field, list[str]]] = {}
    for r in (r for r in raws if shapes[r]):
        bounded.setdefault((id(fields[r]), r if fields[r].kind in ("text", "page") else ""), (fields[r], []))[1].append(r)
    dims = list(bounded.values())
    # Terms: one choice of each field, and one cut of each field with bounds.
    terms = once.select("_q", *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys.values())), *raws, F.lit(1).alias("sign"))
    for i, (f, mine) in enumerate(dims):
        terms = terms.withColumn(f"_at{i}", F.explode(F.array(f.between([F.col(r) for r in mine]))))  # worked out here, once per question
    for i, r in enumerate(raws):
        terms = terms.withColumn("_t", F.explode(fields[r].choices(F.col(r)))).select("*", F.col("_t.mask").alias(f"_m{i}"), F.col("_t.key").alias(f"_f{i}"), (F.col("sign") * F.col("_t.sign")).alias("_s")).drop("_t", "sign").withColumnRenamed("_s", "sign")
    for i in range(len(dims)):
        terms = terms.withColumn("_t", F.explode(cuts_of(F.col(f"_at{i}")))).select("*", F.col("_t.cut").alias(f"_c{i}"), (F.col("sign") * F.col("_t.sign")).alias("_s")).drop("_t", "sign", f"_at{i}").withColumnRenamed("_s", "sign")
    # A term's shape: the masks of all fields, and which fields it bounds.
    cuts = [f"_c{i}" for i in range(len(dims))]
    digits = [*(F.col(f"_m{i}") for i in range(len(raws))), *(F.col(c).isNotNull().cast("int") for c in cuts)]
    terms = terms.withColumn("_shape", sum((d * 3**i for i, d in enumerate(digits)), F.lit(0)).cast("long"))
    terms = written(terms.drop(*raws, *(f"_m{i}" for i in range(len(raws)))), "terms")
    line = [*(f"_k{i}" for i in range(len(keys))), "_shape", *(f"_f{i}" for i in range(len(raws)))]
    used = {r[0]: r[1] for r in terms.groupBy("_shape").agg(F.approx_count_distinct(F.xxhash64(*line))).collect()} or {0: 0}  # at most 3 ** fields * 2 ** bounded ones
    # Facts: keys, places and values, summed up before they are written once per shape in use.
    v = value if how == "count" else value.cast("double") if dict(facts.select(value.alias("v")).dtypes)["v"] == "float" else value
    base = facts.select(*(F.col(f).alias(f"_k{i}") for i, f in enumerate(keys)), *(f.key().alias(f"_f{i}") for i, f in enumerate(fields.values())), *(f.present().alias(f"_p{i}") for i, f in enumerate(fields.values())), *(f.places().alias(c) for c, (f, _) in zip(cuts, dims, strict=True)), v.alias("_v"))
    by = [c for c in base.columns if c != "_v"]
    base = base.groupBy(*by).agg(*([] if how == "count" else [F.sum("_v").alias("_sum")]), F.count("_v").alias("_count"))
    sums = ["_count"] if how == "count" else ["_sum", "_count"]
    many = {}
    if dims:
        base, asked = written(base, "base"), terms
        for c, (f, _) in zip(cuts, dims, strict=True):
            base = base.withColumn(c, F.explode(c))
            places, numbers, many[c] = numbered(base, terms, c)
            base = _replaced(base.withColumn(f"_once{c}", F.col(c)["kind"] >= f.lowest()), c, places)
            asked = _replaced(asked, c, numbers)
        base = base.groupBy(*by, *(f"_once{c}" for c in cuts)).agg(*(F.sum(s).alias(s) for s in sums))
        base, asked = written(base, "numbered"), written(asked, "asked")

    def spread(shapes: list[int]) -> DataFrame:
        """The facts once per shape, as far as some term has their keys: what a shape doesn't look at is null."""
        each = []
        for shape in shapes:
            m = [shape // 3**i % 3 for i in range(len(digits))]
            at = dict(zip(cuts, m[len(raws) :], strict=True))
            use = [F.col(f"_p{i}") if x == 1 else F.col(f"_f{i}").isNotNull() for i, x in enumerate(m[: len(raws)]) if x]
            use += [F.col(c) < many[c] if bound else F.col(f"_once{c}") for c, bound in at.items()]
            own = [*((F.col(f"_f{i}") if x == 2 else F.lit(None).cast("string")).alias(f"_t{i}") for i, x in enumerate(m[: len(raws)])), *((F.col(c) if bound else F.lit(None).cast("long")).alias(f"_n{c}") for c, bound in at.items())]
            each.append(F.when(reduce(Column.__and__, use, F.lit(True)), F.struct(F.lit(shape).cast("long").alias("_shape"), *own)))
        out = base.select(*(f"_k{i}" for i in range(len(keys))), *sums, F.inline(F.array_compact(F.array(*each))))
        out = out.withColumnsRenamed({**{f"_t{i}": f"_f{i}" for i in range(len(raws))}, **{f"_n{c}": c for c in cuts}})
        return _asked_for(out, terms.filter(F.col("_shape").isin(shapes)), line).groupBy(*line, *cuts).agg(*(F.sum(s).alias(s) for s in sums))

    # Shapes with few lines are cut down to them before facts are dealt out.
    light = [s for s, n in used.items() if n * len(used) <= aggregates.MOST_BROADCAST // 2]
    heavy = [s for s in used if s not in light]
    met = reduce(DataFrame.unionByName, [spread(x) for x in (light, heavy) if x])
    if dims:
        got = before_cuts(met, asked.select(*line, *cuts, "_q", "sign"), line, many, sums, "_q")
    else:
        met = small(met)
        met = terms.join(met, reduce(Column.__and__, [terms[c].eqNullSafe(met[c]) for c in line]))
        got = met.groupBy("_q").agg(*(F.sum(F.when(F.col("sign") > 0, F.col(s)).otherwise(-F.col(s))).alias(s) for s in sums))
    n = F.col("_count")
    shown = {"count": n, "sum": F.col("_sum") if how != "count" else n, "mean": F.col("_sum").cast("double") / n if how != "count" else n}[how]
    got = got.filter("_count > 0").select("_q", shown.alias("_value"))
    answers = once.join(got, "_q", "left").select(*(F.col(c).alias(f"_a{i}") for i, c in enumerate([*raws, *keys.values()])), "_value")
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_a{i}")) for i, c in enumerate([*raws, *keys.values()])])
    out = questions.join(small(answers), on, "left")
    return out.select(qid, (F.col("_value") if empty is None or how == "mean" else F.coalesce(F.col("_value"), F.lit(empty))).alias("value"))


def on_grid(grid: DataFrame, questions: DataFrame, criteria: list[tuple[str, str]], value: str | None = None, how: str = "sum", qid: str = "qid") -> DataFrame:
    """qid, value for questions(qid, src, sheet, and per criterion a column number and a string) on many sheets of a sparse grid.

    criteria: pairs of question columns (column number, criterion; both null: none);
    value: the question column with the number of the column that is summed up. Rows
    are those in which that column has a cell, or, without it, the first column
    whose criterion a blank cell does not meet; null if there is none.

    Questions that name the same columns of a sheet share a shape; a shape's rows
    are pivoted once, from the cells of its columns alone.
    """
    blank_meets = lambda k: (split_column(F.col(k))["op"] == "<>") & (split_column(F.col(k))["rhs"] != "") | (split_column(F.col(k))["op"] == "=") & (split_column(F.col(k))["rhs"] == "")
    positive = [F.when(F.col(k).isNotNull() & ~blank_meets(k), F.col(c)) for c, k in criteria]
    base = F.coalesce(*([F.col(value)] if value else []), *positive, F.lit(None).cast("int")).cast("int")
    names = ["src", "sheet", "_base", *(c for c, _ in criteria)]
    asked = questions.withColumn("_base", base)
    shapes = written(asked.select(*names).distinct().withColumn("_shape", F.monotonically_increasing_id()), "shapes")
    roles = F.array(*(F.struct(F.lit(i).alias("_role"), F.col(c).cast("int").alias("c")) for i, c in enumerate(names[2:])))
    wanted = shapes.select("src", "sheet", "_shape", F.inline(roles)).filter("c is not null")
    cells = grid.join(small(wanted), ["src", "sheet", "c"])
    pick = lambda i, c: F.max(F.when(F.col("_role") == i, F.col(c)))
    rows = cells.groupBy("_shape", "r").agg(*(pick(i, c).alias(f"{c}{i}") for i in range(len(criteria) + 1) for c in ("v_num", "v_txt")))
    rows = rows.filter("v_num0 is not null or v_txt0 is not null")
    asked = asked.join(small(shapes.withColumnsRenamed({n: f"_n{i}" for i, n in enumerate(names)})), reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_n{i}")) for i, n in enumerate(names)]))
    fields = {k: Field("grid", F.col(f"v_num{i}"), F.col(f"v_txt{i}")) for i, (_, k) in enumerate(criteria, 1)}
    got = answer(rows, asked.select(qid, "_shape", *fields), fields, F.col("v_num0") if how != "count" else F.lit(1), how, {"_shape": "_shape"}, qid=qid)
    return asked.select(qid, "_base").join(got.withColumnRenamed("value", "_v"), qid, "left").select(qid, F.when(F.col("_base").isNotNull(), F.col("_v")).alias("value"))


def compared(facts: DataFrame, criteria: DataFrame, equal: dict[str, str], compare: dict[str, list[tuple[str, str]]], value: Column, how: str = "sum", empty: float | int | None = 0, qid: str = "qid") -> DataFrame:
    """qid, value for each row of criteria, with bounds that are numbers: any number per column, on any number of columns, with or without equal ones.

    equal: as in aggregates.conditional(); compare: fact column -> (operator, criteria
    column) pairs. A question with a null bound is met by no row.
    """
    text = {f for f in equal if dict(facts.dtypes)[f] == "string"}
    fold = lambda c, f: ascii_fold(F.coalesce(c, F.lit(""))) if f in text else c
    facts = facts.withColumns({f"_e{i}": ascii_fold(F.col(f)) if f in text else F.col(f) for i, f in enumerate(equal)})
    pairs = [(f, op, c) for f, each in compare.items() for op, c in each]
    number = {c: F.col(c).cast("double") for _, _, c in pairs}
    shown = lambda x: F.when(F.abs(x) == INF, F.when(x > 0, "1e999").otherwise("-1e999")).otherwise(x.cast("string"))
    asked = criteria.select(qid, *(fold(F.col(c), f).alias(f"_e{i}") for i, (f, c) in enumerate(equal.items())), *(F.concat(F.lit(op), shown(number[c])).alias(f"_b{i}") for i, (_, op, c) in enumerate(pairs)))
    whole = reduce(Column.__and__, [F.col(f"_b{i}").isNotNull() for i in range(len(pairs))], F.lit(True))
    field = {f: Field("number", F.col(f).cast("double")) for f in compare}
    facts = facts.filter(reduce(Column.__and__, [F.col(f"_e{i}").isNotNull() for i in range(len(equal))], F.lit(True)))
    got = answer(facts, asked.filter(whole), {f"_b{i}": field[f] for i, (f, _, _) in enumerate(pairs)}, value, how, {f"_e{i}": f"_e{i}" for i in range(len(equal))}, empty, qid)
    none = asked.filter(~whole).select(qid, F.lit(None if how == "mean" else empty).cast(got.schema["value"].dataType).alias("value"))
    return got.unionByName(none)
