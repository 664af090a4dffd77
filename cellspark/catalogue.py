"""All queries of the table engine, by name, with equivalent SQL.

lineitem and orders stand for long observation tables, nation and region for
sparse grids, small aggregates of either for pages. Money is summed as exact
decimals, so that results do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import criteria as cr
from .functions import scalars as sc
from .operators import aggregates, lookups, publish, ranges, ranking, series, verification
from .plans import levels
from .sources import scratch, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def values(rows: list[tuple]) -> str:
    """Rows as SQL."""
    one = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)
    return ", ".join(f"({', '.join(map(one, r))})" for r in rows)


# -------------------------------------------------- conditional aggregates, long
CRITERIA = [(i, f, s, y) for i, (f, s, y) in enumerate((f, s, y) for f in ("A", "N", "R", "Z") for s in ("F", "O") for y in range(1992, 1999))]
SUM = "coalesce(cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 0)"


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "lineitem").withColumn("yr", F.year("l_shipdate").cast("long"))


@query(f"WITH q(qid, flag, status, yr) AS (VALUES {values(CRITERIA)}) SELECT qid, {SUM} AS value FROM q LEFT JOIN lineitem ON l_returnflag = flag AND l_linestatus = status AND year(l_shipdate) = yr GROUP BY qid")
def sumifs_batch(spark, d):
    q = spark.createDataFrame(CRITERIA, "qid int, flag string, status string, yr int").withColumnRenamed("yr", "year")
    out = aggregates.conditional(_lineitem(spark, d), q, {"l_returnflag": "flag", "l_linestatus": "status", "yr": "year"}, F.sum(money("l_extendedprice")))
    return out.select("qid", F.col("value").cast("double").alias("value"))


@query(f"SELECT {SUM} AS value FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'")
def sumifs_single(spark, d):
    hit = cr.on_long_text(F.col("l_returnflag"), cr.split("A")) & cr.on_long_text(F.col("l_linestatus"), cr.split("=F"))
    return aggregates.one_pass(t(spark, d, "lineitem"), {"value": F.coalesce(F.sum(F.when(hit, money("l_extendedprice"))).cast("double"), F.lit(0.0))})


@query(f"""SELECT {SUM.replace('sum(cast(l_extendedprice AS DECIMAL(18,2)))', "sum(cast(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_quantity >= 25 AND l_returnflag <> 'N')")} AS at_least,
count(*) FILTER (WHERE l_quantity < 10) AS below, count(*) FILTER (WHERE l_quantity <> 10) AS other, count(*) FILTER (WHERE l_returnflag <> '') AS filled, count(*) FILTER (WHERE l_returnflag > 'A') AS later FROM lineitem""")
def sumifs_comparison(spark, d):
    num, txt = F.col("l_quantity"), F.col("l_returnflag")
    n = lambda c: F.count(F.when(c, 1))
    hit = cr.on_long_number(num, cr.split(">= 25")) & cr.on_long_text(txt, cr.split("<>n"))
    return aggregates.one_pass(
        t(spark, d, "lineitem"),
        {
            "at_least": F.coalesce(F.sum(F.when(hit, money("l_extendedprice"))).cast("double"), F.lit(0.0)),
            "below": n(cr.on_long_number(num, cr.split("<10"))),
            "other": n(cr.on_long_number(num, cr.split("<>10"))),
            "filled": n(cr.on_long_text(txt, cr.split("<>"))),
            "later": n(cr.on_long_text(txt, cr.split(">a"))),
        },
    )


BOUNDS = [(i, f, q) for i, (f, q) in enumerate((f, q) for f in ("a", "R") for q in (5.0, 25.0, 45.0, 99.0))]


@query(f"WITH q(qid, flag, q) AS (VALUES {values(BOUNDS)}) SELECT qid, {SUM} AS value FROM q LEFT JOIN lineitem ON lower(l_returnflag) = lower(flag) AND l_quantity >= q GROUP BY qid")
def sumifs_bounds_batch(spark, d):
    q = spark.createDataFrame(BOUNDS, "qid int, flag string, least double")
    out = aggregates.bounded(t(spark, d, "lineitem"), q, {"l_returnflag": "flag"}, ("l_quantity", ">=", "least"), money("l_extendedprice"))
    return out.select("qid", F.col("value").cast("double").alias("value"))


NOCASE = [(1, "building"), (2, "MACHINERY"), (3, "Automobile"), (4, "none"), (5, None)]


@query(f"WITH q(qid, seg) AS (VALUES {values(NOCASE)}) SELECT qid, coalesce(cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 0) AS value FROM q LEFT JOIN customer ON lower(c_mktsegment) = lower(coalesce(seg, '')) GROUP BY qid")
def sumifs_nocase(spark, d):
    q = spark.createDataFrame(NOCASE, "qid int, seg string")
    return aggregates.conditional(t(spark, d, "customer"), q, {"c_mktsegment": "seg"}, F.sum(money("c_acctbal"))).select("qid", F.col("value").cast("double").alias("value"))


@query("SELECT coalesce(cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = '') AS DOUBLE), 0) AS value, count(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag <> '') AS filled FROM lineitem")
def sumifs_blank_criterion(spark, d):
    txt = F.col("l_returnflag")
    return aggregates.one_pass(t(spark, d, "lineitem"), {"value": F.coalesce(F.sum(F.when(cr.on_long_text(txt, cr.split(None)), money("l_extendedprice"))).cast("double"), F.lit(0.0)), "filled": F.count(F.when(cr.on_long_text(txt, cr.split("<>")), 1))})


@query(f"WITH q(qid, flag, status, yr) AS (VALUES {values(CRITERIA)}) SELECT qid, count(l_orderkey) AS value FROM q LEFT JOIN lineitem ON l_returnflag = flag AND l_linestatus = status AND year(l_shipdate) = yr GROUP BY qid")
def countifs_long(spark, d):
    q = spark.createDataFrame(CRITERIA, "qid int, flag string, status string, yr int").withColumnRenamed("yr", "year")
    return aggregates.conditional(_lineitem(spark, d), q, {"l_returnflag": "flag", "l_linestatus": "status", "yr": "year"}, F.count("l_returnflag"))


@query(f"WITH q(qid, flag, status, yr) AS (VALUES {values(CRITERIA)}) SELECT qid, round(cast(sum(cast(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(l_quantity), 0), 6) AS value FROM q LEFT JOIN lineitem ON l_returnflag = flag AND l_linestatus = status AND year(l_shipdate) = yr GROUP BY qid")
def averageifs_long(spark, d):
    q = spark.createDataFrame(CRITERIA, "qid int, flag string, status string, yr int").withColumnRenamed("yr", "year")
    mean = F.sum(money("l_quantity")).cast("double") / F.count("l_quantity")
    return aggregates.conditional(_lineitem(spark, d), q, {"l_returnflag": "flag", "l_linestatus": "status", "yr": "year"}, mean, empty=None).select("qid", F.round("value", 6).alias("value"))


# ------------------------------------------------------------------------- grids
MELT = """g AS (SELECT 1 AS r, c, NULL::DOUBLE AS v_num, v_txt FROM (VALUES (1, 'n_nationkey'), (2, 'n_name'), (3, 'n_regionkey')) h(c, v_txt)
UNION ALL SELECT row_number() OVER (ORDER BY n_nationkey) + 1, 1, n_nationkey::DOUBLE, NULL FROM nation
UNION ALL SELECT row_number() OVER (ORDER BY n_nationkey) + 1, 2, NULL, n_name FROM nation
UNION ALL SELECT row_number() OVER (ORDER BY n_nationkey) + 1, 3, n_regionkey::DOUBLE, NULL FROM nation)"""


def _grid(spark, d) -> DataFrame:
    return tables.melt(t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), "etc", "nation", ["n_nationkey"])


@query(f"WITH {MELT} SELECT 'etc' AS src, 'nation' AS sheet, cast(r AS INTEGER) AS r, c, v_num, v_txt FROM g")
def grid_melt(spark, d):
    return _grid(spark, d)


@query("SELECT cast(sum(n_nationkey) AS DOUBLE) AS total, count(*) AS matches FROM nation WHERE n_regionkey = 2")
def grid_sumifs(spark, d):
    return aggregates.grid_conditional(_grid(spark, d), "etc", "nation", 1, {3: cr.split("2")})


@query("SELECT cast(sum(n_nationkey) AS DOUBLE) AS total, count(*) AS matches FROM (SELECT n_nationkey, n_regionkey FROM nation UNION ALL SELECT NULL, NULL) WHERE n_regionkey IS DISTINCT FROM 2")
def grid_countifs_negated(spark, d):
    return aggregates.grid_conditional(_grid(spark, d), "etc", "nation", 1, {3: cr.split("<>2")})


@query("SELECT count(*) FILTER (WHERE n_regionkey > 2) AS more, count(*) FILTER (WHERE lower(n_name) > 'j') + 1 AS later, cast(0 AS BIGINT) AS blank FROM nation")
def grid_criteria(spark, d):
    g = aggregates.pivot_grid(_grid(spark, d), [2, 3])
    n = lambda c: F.count(F.when(c, 1))
    return g.agg(n(cr.on_grid(F.col("n3"), F.col("t3"), cr.split(">2"))).alias("more"), n(cr.on_grid(F.col("n2"), F.col("t2"), cr.split(">J"))).alias("later"), n(cr.on_grid(F.col("n3"), F.col("t3"), cr.split("="))).alias("blank"))


PLACES = [(1, 2, 1), (2, 3, 2), (3, 26, 3), (4, 99, 1), (5, 1, 2), (6, 2, 9)]


@query(f"WITH {MELT}, q(qid, r, c) AS (VALUES {values(PLACES)}) SELECT qid, CASE WHEN v_txt IS NULL THEN coalesce(v_num, 0) END AS num, v_txt AS txt FROM q LEFT JOIN g USING (r, c)")
def gridcell_default_zero(spark, d):
    q = spark.createDataFrame(PLACES, "qid int, r int, c int").withColumns({"src": F.lit("etc"), "sheet": F.lit("nation")})
    return lookups.external_cell(q, _grid(spark, d)).select("qid", "num", "txt")


NEEDLES = [(1, "FRANCE"), (2, "nation_7"), (3, "NATION_3"), (4, "none"), (5, "n_name"), (6, "JAPAN"), (7, "NATION_24")]


def _needles(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "qid int, needle string").withColumns({"src": F.lit("etc"), "sheet": F.lit("nation")})


@query(f"WITH {MELT}, q(qid, needle) AS (VALUES {values(NEEDLES)}), h AS (SELECT qid, min(r) AS r FROM q LEFT JOIN g ON c = 2 AND lower(v_txt) = lower(needle) GROUP BY qid) SELECT qid, v_num AS num, v_txt AS txt FROM h LEFT JOIN g ON h.r = g.r AND g.c = 3")
def vlookup_exact(spark, d):
    return lookups.vlookup(_needles(spark, NEEDLES), _grid(spark, d), 2, 2)


ACROSS = [(1, "N_NAME"), (2, "n_regionkey"), (3, "missing")]


@query(f"WITH {MELT}, q(qid, needle) AS (VALUES {values(ACROSS)}), h AS (SELECT qid, min(c) AS c FROM q LEFT JOIN g ON r = 1 AND lower(v_txt) = lower(needle) GROUP BY qid) SELECT qid, v_num AS num, v_txt AS txt FROM h LEFT JOIN g ON h.c = g.c AND g.r = 4")
def hlookup_exact(spark, d):
    return lookups.hlookup(_needles(spark, ACROSS), _grid(spark, d), 1, 4)


@query(f"WITH {MELT}, q(qid, needle) AS (VALUES {values(NEEDLES)}), h AS (SELECT qid, min(r) AS r FROM q LEFT JOIN g ON c = 2 AND lower(v_txt) = lower(needle) GROUP BY qid) SELECT qid, coalesce(v_txt, cast(cast(v_num AS BIGINT) AS VARCHAR), '-') AS shown FROM h LEFT JOIN g ON h.r = g.r AND g.c = 3")
def vlookup_miss_iferror(spark, d):
    got = lookups.vlookup(_needles(spark, NEEDLES), _grid(spark, d), 2, 2)
    return got.select("qid", sc.if_error(sc.general_text(sc.cell(F.col("num"), F.col("txt"))), F.lit("-")).alias("shown"))


@query(f"WITH o AS (SELECT n_name, n_nationkey, row_number() OVER (ORDER BY n_nationkey) AS pos FROM nation), q(qid, needle) AS (VALUES {values(NEEDLES)}) SELECT qid, pos, cast(n_nationkey AS DOUBLE) AS num FROM q LEFT JOIN o ON lower(n_name) = lower(needle)")
def index_match(spark, d):
    page = _grid(spark, d).withColumnsRenamed({"v_num": "num", "v_txt": "txt"})
    names, numbers = lookups.positions(page, 2, 2, 26, 2), lookups.positions(page, 2, 1, 26, 1)
    found = lookups.match(_needles(spark, NEEDLES), names)
    return found.join(lookups.index(found, numbers, 25), "qid").select("qid", F.col("pos").cast("long").alias("pos"), "num")


# ------------------------------------------------------------------------ ranges
@query("""SELECT cast(n_regionkey AS INTEGER) AS qid, cast(sum(n_nationkey) AS DOUBLE) AS total, cast(max(n_nationkey) AS DOUBLE) AS largest, 2 * count(*) AS filled FROM nation GROUP BY 1
UNION ALL SELECT 99, 0, 0, 0""")
def range_sum_max_counta(spark, d):
    n = t(spark, d, "nation")
    r = F.row_number().over(ranking.W.partitionBy("n_regionkey").orderBy("n_nationkey"))
    cells = n.select(F.lit("p").alias("part"), F.col("n_regionkey").cast("string").alias("sheet"), r.alias("r"), F.inline(F.array(F.struct(F.lit(1).alias("c"), F.col("n_nationkey").cast("double").alias("num"), F.lit(None).cast("string").alias("txt")), F.struct(F.lit(2).alias("c"), F.lit(None).cast("double").alias("num"), F.col("n_name").alias("txt")))))
    rect = n.select(F.col("n_regionkey").cast("int").alias("qid"), F.col("n_regionkey").cast("string").alias("sheet")).distinct().union(spark.createDataFrame([(99, "none")], "qid int, sheet string"))
    rect = rect.select("qid", F.lit("p").alias("part"), "sheet", F.lit(1).alias("r1"), F.lit(1).alias("c1"), F.lit(1000).alias("r2"), F.lit(2).alias("c2"))
    return ranges.range_aggregates(rect, cells)


@query("SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 150000 AND o_orderpriority <> '1-URGENT') AS n FROM orders GROUP BY 1")
def rangecount(spark, d):
    o = t(spark, d, "orders")
    null = F.lit(None)
    return ranges.count_where(o, cr.on_page(F.col("o_totalprice"), null.cast("string"), cr.split(">150000")), cr.on_page(null.cast("double"), F.col("o_orderpriority"), cr.split("<>1-urgent")), by=["o_orderstatus"])


@query("SELECT count(*) AS n FROM nation WHERE n_regionkey <> 2")
def sumproduct_isnumber_ne(spark, d):
    g = aggregates.pivot_grid(_grid(spark, d), [1, 3])
    return ranges.count_where(g, F.col("n1").isNotNull(), cr.on_page(F.col("n3"), F.col("t3"), cr.split("<>2")))


@query("SELECT count(*) FILTER (WHERE p_size = 7) AS sevens, count(*) FILTER (WHERE upper(p_brand) = 'BRAND#11') AS brand, count(*) FILTER (WHERE p_size >= 40) AS large FROM part")
def countif_numeric_text(spark, d):
    null = F.lit(None)
    num, txt = F.col("p_size").cast("double"), F.col("p_brand")
    return t(spark, d, "part").agg(F.count_if(cr.on_page(num, null.cast("string"), cr.split("7"))).alias("sevens"), F.count_if(cr.on_page(null.cast("double"), txt, cr.split("brand#11"))).alias("brand"), F.count_if(cr.on_page(num, null.cast("string"), cr.split(">=40"))).alias("large"))


# ----------------------------------------------------------------------- ranking
@query("SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank FROM customer")
def rank_desc(spark, d):
    return ranking.rank_descending(t(spark, d, "customer"), "c_acctbal", ["c_nationkey"]).select("c_custkey", F.col("rank").cast("long").alias("rank"))


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS pos, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) + count(*) OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) - 1 AS both FROM part")
def rank_countif_unique(spark, d):
    p = ranking.sort_position(t(spark, d, "part"), "p_size", "p_partkey", ["p_brand"])
    p = ranking.running_count(ranking.rank_descending(p, "p_size", ["p_brand"]), "p_size", "p_partkey", ["p_brand"])
    return p.select("p_partkey", F.col("pos").cast("long").alias("pos"), (F.col("rank") + F.col("nth") - 1).alias("both"))


@query("SELECT n_regionkey, pos, n_name FROM (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) AS pos FROM nation) WHERE pos <= 3")
def sorted_table_index_match(spark, d):
    return ranking.sort_position(t(spark, d, "nation"), "n_nationkey", "n_name", ["n_regionkey"]).filter("pos <= 3").select("n_regionkey", F.col("pos").cast("long").alias("pos"), "n_name")


@query("SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey, NULL FROM customer WHERE NOT (c_acctbal > 0 AND c_mktsegment <> 'BUILDING')")
def rank_excluding(spark, d):
    return ranking.rank_where(t(spark, d, "customer"), "c_acctbal", (F.col("c_acctbal") > 0) & (F.col("c_mktsegment") != "BUILDING"), ["c_nationkey"]).select("c_custkey", F.col("rank").cast("long").alias("rank"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def topk_customers(spark, d):
    return t(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)


@query("SELECT o_custkey, min(o_orderkey) AS first_order, arg_min(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY 1")
def first_match(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"), F.min_by("o_orderpriority", "o_orderkey").alias("priority"))


# ------------------------------------------------------------------------ series
@query("SELECT anchor, cast(i + 1 AS INTEGER) AS pos, cast(anchor - 11 + i AS INTEGER) AS year FROM (SELECT DISTINCT cast(year(o_orderdate) AS INTEGER) AS anchor FROM orders), range(12) x(i)")
def anchor_year_series(spark, d):
    return series.years_before(t(spark, d, "orders").select(F.year("o_orderdate").alias("anchor")).distinct(), "anchor", 12)


YEARLY = "y AS (SELECT l_returnflag AS flag, year(l_shipdate) AS yr, cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1, 2)"


def _yearly(spark, d) -> DataFrame:
    return _lineitem(spark, d).groupBy(F.col("l_returnflag").alias("flag"), "yr").agg(F.sum(money("l_extendedprice")).cast("double").alias("total"))


@query(f"WITH {YEARLY}, w AS (SELECT *, lag(total) OVER s AS p, lag(yr) OVER s AS py FROM y WINDOW s AS (PARTITION BY flag ORDER BY yr)) SELECT flag, yr, CASE WHEN py < 1995 AND yr >= 1995 THEN NULL ELSE round((total - p) / (p / 100), 6) END AS growth, CASE WHEN py < 1995 AND yr >= 1995 THEN '…' WHEN p IS NULL OR p = 0 THEN '-' END AS growth_mark FROM w")
def growth_rate_break(spark, d):
    return series.growth(_yearly(spark, d), "total", "yr", ["flag"], 1995).select("flag", "yr", F.round("growth", 6).alias("growth"), "growth_mark")


@query(f"WITH {YEARLY} SELECT flag, yr, round(total / (sum(total) OVER (PARTITION BY flag) / 100), 6) AS pct FROM y")
def share_percent(spark, d):
    return _yearly(spark, d).select("flag", "yr", F.round(series.share(F.col("total"), ["flag"]), 6).alias("pct"))


# ----------------------------------------------------------------------- scalars
@query("SELECT l_orderkey, l_linenumber, round(cast(l_extendedprice AS DECIMAL(18,4)) / 10, 1)::DOUBLE AS r1, round(cast(-l_extendedprice AS DECIMAL(18,4)), 0)::DOUBLE AS r0 FROM lineitem")
def excel_round(spark, d):
    x = F.col("l_extendedprice")
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", sc.round_half_away(x / 10, 1).alias("r1"), sc.round_half_away(-x, 0).alias("r0"))


@query("SELECT c_custkey, format('{:,.1f}', round(cast(c_acctbal AS DECIMAL(18,2)), 1)::DOUBLE) AS grouped FROM customer")
def text_fixed_grouped(spark, d):
    return t(spark, d, "customer").select("c_custkey", sc.text_fixed(F.col("c_acctbal"), 1, True).alias("grouped"))


@query("SELECT c_custkey, round(c_acctbal * 1.0, 2) AS plain, round(c_acctbal / 100, 6) AS share, NULL::DOUBLE AS bad FROM customer")
def numbervalue_parse(spark, d):
    shown = F.format_number("c_acctbal", 2)
    return t(spark, d, "customer").select("c_custkey", sc.number_value(F.concat(F.lit(" "), shown)).alias("plain"), F.round(sc.number_value(F.concat(shown, F.lit("%"))), 6).alias("share"), sc.number_value(F.concat(shown, F.lit("x"))).alias("bad"))


@query("SELECT o_orderkey, cast(year(o_orderdate) AS VARCHAR) || '년 ' || o_orderstatus AS label, NULL::VARCHAR AS broken FROM orders")
def concat_general(spark, d):
    text = lambda s: sc.cell(txt=s)
    year = sc.cell(num=F.year("o_orderdate"))
    return t(spark, d, "orders").select("o_orderkey", sc.concat(year, text(F.lit("년 ")), text(F.col("o_orderstatus"))).alias("label"), sc.concat(year, sc.cell(num=sc.divide(F.lit(1.0), F.lit(0.0)))).alias("broken"))


@query("SELECT p_partkey, replace(p_name, ' ', '+') AS swapped, left(p_name, 4) AS l, right(p_name, 3) AS r, length(p_name) AS n, cast(nullif(instr(p_name, 'a'), 0) AS DOUBLE) AS place FROM part")
def substitute_left_right_len_find(spark, d):
    s = F.col("p_name")
    return t(spark, d, "part").select("p_partkey", sc.substitute(s, F.lit(" "), F.lit("+")).alias("swapped"), sc.left(s, F.lit(4)).alias("l"), sc.right(s, F.lit(3)).alias("r"), F.length(s).cast("long").alias("n"), sc.find(F.lit("a"), s).alias("place"))


@query("SELECT p_partkey, trunc(p_size / 7)::DOUBLE AS q, trunc(-p_size / 7)::DOUBLE + 0 AS nq, (p_size - 7 * floor(p_size / 7))::DOUBLE AS m, (p_size + 7 * floor(p_size / -7))::DOUBLE AS nm, NULL::DOUBLE AS bad FROM part")
def quotient_mod(spark, d):
    x = F.col("p_size").cast("double")
    return t(spark, d, "part").select("p_partkey", sc.quotient(x, F.lit(7.0)).alias("q"), (sc.quotient(-x, F.lit(7.0)) + F.lit(0.0)).alias("nq"), sc.modulo(x, F.lit(7.0)).alias("m"), sc.modulo(x, F.lit(-7.0)).alias("nm"), sc.modulo(x, F.lit(0.0)).alias("bad"))


@query("SELECT cast(count(v) AS DOUBLE) AS numbers, cast(sum(v) AS DOUBLE) AS total FROM (SELECT n_nationkey AS v FROM nation UNION ALL SELECT n_regionkey FROM nation)")
def n_isnumber(spark, d):
    v = sc.cell(F.col("v_num"), F.col("v_txt"))
    return _grid(spark, d).agg(F.sum(sc.is_number(v)).alias("numbers"), F.sum(sc.number_or_zero(v)).alias("total"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 5000 AND c_mktsegment = 'BUILDING' THEN 'big' ELSE 'other' END AS class, CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS below FROM customer")
def cmp_and_if(spark, d):
    balance, segment = sc.cell(num=F.col("c_acctbal")), sc.cell(txt=F.col("c_mktsegment"))
    both = sc.all_of(sc.cell(num=sc.compare(balance, ">", sc.cell(num=F.lit(5000)))), sc.cell(num=sc.compare(segment, "=", sc.cell(txt=F.lit("BUILDING")))))
    return t(spark, d, "customer").select("c_custkey", sc.if_else(sc.cell(num=both), F.lit("big"), F.lit("other")).alias("class"), sc.compare(balance, "<", sc.cell()).alias("below"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN '-' ELSE cast(n_regionkey AS VARCHAR) END AS shown, '-' AS text_shown FROM nation")
def zero_dash(spark, d):
    v = sc.zero_dash(sc.cell(num=F.col("n_regionkey")))
    return t(spark, d, "nation").select("n_nationkey", sc.general_text(v).alias("shown"), sc.general_text(sc.zero_dash(sc.cell(txt=F.col("n_name")))).alias("text_shown"))


@query(r"SELECT n_nationkey, regexp_replace(n_name || '~*~?~~', '~([~*?])', '\1', 'g') AS plain, regexp_matches(regexp_replace(n_name || '~*~?~~*', '~[~*?]', '', 'g'), '[*?]') AS wild FROM nation")
def wildcard_unescape(spark, d):
    s = F.concat("n_name", F.lit("~*~?~~"))
    return t(spark, d, "nation").select("n_nationkey", sc.unescape(s).alias("plain"), sc.has_wildcard(F.concat(s, F.lit("*"))).alias("wild"))


RAW = (">=#", "<> x #", "<>", "=", "  plain #", ">text", "<#", "=a=#", None)
_RAW = f"CASE c_custkey % {len(RAW)} {' '.join(f'WHEN {i} THEN {values([(x,)])[1:-1]}' for i, x in enumerate(RAW))} END"


@query(f"WITH q AS (SELECT c_custkey AS id, replace({_RAW}, '#', cast(c_custkey AS VARCHAR)) AS raw FROM customer) SELECT id, CASE WHEN regexp_extract(coalesce(raw, ''), '^(<>|>=|<=|>|<|=)?\\s*(.*)$', 1) = '' THEN '=' ELSE regexp_extract(raw, '^(<>|>=|<=|>|<|=)?\\s*(.*)$', 1) END AS op, regexp_extract(coalesce(raw, ''), '^(<>|>=|<=|>|<|=)?\\s*(.*)$', 2) AS rhs FROM q")
def split_criteria(spark, d):
    k = F.col("c_custkey")
    raw = F.replace(F.get(F.array(*map(F.lit, RAW)), (k % len(RAW)).cast("int")), F.lit("#"), k.cast("string"))
    return t(spark, d, "customer").select(k.alias("id"), cr.split_column(raw).alias("k")).select("id", "k.op", "k.rhs")


# ------------------------------------------------------------------ verification
SPECS = "s AS (SELECT 'p' || n_regionkey AS part, CASE WHEN n_nationkey % 7 = 6 THEN '_h' ELSE 'a' END AS sheet, n_name AS ref, CASE WHEN n_nationkey % 5 = 4 THEN 'presentation' ELSE 'expr' END AS kind, n_nationkey AS k FROM nation)"
VERDICTS = f"{SPECS}, v AS (SELECT part, sheet, ref, k, CASE WHEN k % 11 = 10 THEN 'no-oracle' WHEN kind <> 'expr' THEN kind WHEN k % 13 = 12 THEN 'error' WHEN k % 6 = 5 THEN 'mismatch' ELSE 'match' END AS verdict FROM s WHERE sheet <> '_h')"


def _verdict_inputs(spark, d):
    k = F.col("n_nationkey")
    s = t(spark, d, "nation").select(F.concat(F.lit("p"), "n_regionkey").alias("part"), F.when(k % 7 == 6, "_h").otherwise("a").alias("sheet"), F.col("n_name").alias("ref"), F.when(k % 5 == 4, "presentation").otherwise("expr").alias("kind"), k.alias("k"))
    none = F.lit(None).cast("string")
    oracle = s.filter("k % 11 <> 10").select("part", "sheet", "ref", (F.col("k") * 1000.0).alias("num"), none.alias("txt"))
    got = F.col("k") * 1000.0 + F.when(F.col("k") % 6 == 5, 1.0).otherwise(1e-10)
    computed = s.select("part", "sheet", "ref", F.when(F.col("k") % 2 == 0, got).alias("num"), F.when(F.col("k") % 2 == 1, F.format_number(F.floor(got), 0)).alias("txt"), F.when(F.col("k") % 13 == 12, "failed").alias("err"))
    return s, oracle, computed


def _verdicts(spark, d) -> DataFrame:
    return verification.verdicts(*_verdict_inputs(spark, d))


@query(f"WITH {VERDICTS} SELECT part, sheet, ref, verdict FROM v")
def verdicts(spark, d):
    return _verdicts(spark, d).select("part", "sheet", "ref", "verdict")


@query(f"WITH {VERDICTS} SELECT part, verdict, count(*) AS n FROM v GROUP BY ALL")
def verify_summary(spark, d):
    return verification.summary(_verdicts(spark, d))


@query(f"WITH {VERDICTS}, c AS (SELECT part, count(*) FILTER (WHERE verdict IN ('match', 'mismatch', 'error', 'known-divergence')) AS comparable, count(*) FILTER (WHERE verdict = 'match') AS matches, count(*) FILTER (WHERE verdict IN ('mismatch', 'error', 'unsupported', 'no-oracle')) AS failures FROM v GROUP BY part) SELECT part, comparable, matches, round(matches * 100.0 / nullif(comparable, 0), 6) AS rate, failures = 0 AS passed FROM c")
def verify_rates(spark, d):
    return verification.rates(_verdicts(spark, d)).withColumn("rate", F.round("rate", 6)).drop("failures")


EXEMPT = "x AS (SELECT part, sheet, ref, k * 1000.0 AS e_num, CASE WHEN k % 4 = 1 THEN k * 1000.0 + 1 ELSE 5.0 END AS g_num FROM s WHERE k % 3 <> 0)"


def _exemptions(spark, d) -> DataFrame:
    s, _, _ = _verdict_inputs(spark, d)
    return s.filter("k % 3 <> 0").select("part", "sheet", "ref", (F.col("k") * 1000.0).alias("e_num"), F.when(F.col("k") % 4 == 1, F.col("k") * 1000.0 + 1).otherwise(5.0).alias("g_num"))


def _numeric(results: DataFrame) -> DataFrame:
    return results.withColumn("g_num", F.coalesce("g_num", sc.number_value(F.col("g_txt"))))


@query(f"WITH {VERDICTS}, {EXEMPT} SELECT v.part, v.sheet, v.ref, CASE WHEN verdict = 'mismatch' AND x.ref IS NOT NULL AND k % 4 = 1 THEN 'known-divergence' ELSE verdict END AS verdict FROM v LEFT JOIN x USING (part, sheet, ref)")
def exemptions_applied(spark, d):
    return verification.exempt(_numeric(_verdicts(spark, d)), _exemptions(spark, d)).select("part", "sheet", "ref", "verdict")


@query(f"WITH {VERDICTS}, {EXEMPT} SELECT x.part, x.sheet, x.ref, CASE WHEN verdict IS NULL THEN 'the cell is gone' WHEN verdict = 'match' THEN 'it matches now' WHEN k % 11 = 10 THEN 'the published value has changed' ELSE 'the computed value has changed' END AS reason FROM x LEFT JOIN v USING (part, sheet, ref) WHERE NOT (verdict IS NOT NULL AND verdict <> 'match' AND k % 11 <> 10 AND k % 4 = 1 AND k % 6 = 5)")
def stale_exemptions(spark, d):
    return verification.stale(_exemptions(spark, d), _numeric(_verdicts(spark, d)))


@query("SELECT regexp_replace(trim(regexp_replace(props_like, '\\s*\\([^()]*\\)\\s*$', '')), '\\d+', '#', 'g') AS key, count(*) AS n, min(event_id) AS sample FROM (SELECT event_id, event_type || ' failed at row ' || user_id || ' (batch ' || event_id || ')' AS props_like FROM events) GROUP BY 1")
def reason_key_groups(spark, d):
    e = t(spark, d, "events").select("event_id", F.concat("event_type", F.lit(" failed at row "), "user_id", F.lit(" (batch "), "event_id", F.lit(")")).alias("reason"))
    return verification.reason_groups(e, "reason", "event_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'missing' WHEN c_custkey % 10 = 4 THEN 'extra' ELSE 'changed' END AS status FROM customer WHERE c_custkey % 10 IN (3, 4, 5)")
def snapshot_diff(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("num"), F.lit(None).cast("string").alias("txt"))
    new = c.filter("c_custkey % 10 <> 3").withColumn("num", F.col("num") + F.when(F.col("c_custkey") % 10 == 5, 1.0).otherwise(0.0))
    return verification.snapshot_diff(c.filter("c_custkey % 10 <> 4"), new, ["c_custkey"])


@query("SELECT l_returnflag AS table_id, count(*) AS rows, max(cast(year(l_shipdate) AS VARCHAR)) AS max_period FROM lineitem GROUP BY 1")
def fingerprint(spark, d):
    return tables.fingerprint(t(spark, d, "lineitem").withColumn("period", F.year("l_shipdate").cast("string")), "l_returnflag", "period")


@query(f"WITH {MELT} SELECT 'etc' AS src, count(*) AS rows, cast(1 AS BIGINT) AS sheets FROM g")
def grid_fingerprint(spark, d):
    return tables.grid_fingerprint(_grid(spark, d))


# ------------------------------------------------------------------ dependencies
EDGES = "e AS (SELECT p_partkey AS cell, p_partkey // 2 AS needs FROM part WHERE p_partkey >= 2 UNION SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey >= 3)"


def _edges(spark, d) -> DataFrame:
    p = t(spark, d, "part").select(F.col("p_partkey").alias("cell"))
    by = lambda k: p.filter(F.col("cell") >= k).select("cell", F.floor(F.col("cell") / k).alias("needs"))
    return by(2).union(by(3)).distinct()


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT cell, needs AS leaf FROM e UNION SELECT r.cell, e.needs FROM r JOIN e ON r.leaf = e.cell) SELECT cell, leaf FROM r WHERE leaf NOT IN (SELECT cell FROM e)")
def transitive_leaves(spark, d):
    return levels.leaves(_edges(spark, d))


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT DISTINCT p_partkey AS cell, 0 AS level FROM part UNION SELECT e.cell, r.level + 1 FROM r JOIN e ON e.needs = r.cell) SELECT cell, max(level) AS level FROM r GROUP BY cell")
def cell_levels(spark, d):
    return levels.levels(t(spark, d, "part").select(F.col("p_partkey").alias("cell")), _edges(spark, d))


@query("WITH n AS (SELECT c_nationkey AS k, cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS num FROM customer GROUP BY 1), a AS (SELECT round(sum(num), 2) AS num FROM n) SELECT 'n' || k AS cell, round(num, 4) AS num FROM n UNION ALL SELECT 'total', round(num, 4) FROM a UNION ALL SELECT 's' || k, round(n.num / (a.num / 100), 4) FROM n, a")
def levelled_values(spark, d):
    n = t(spark, d, "customer").groupBy("c_nationkey").agg(F.sum(money("c_acctbal")).cast("double").alias("num"))
    inputs = n.select(F.concat(F.lit("n"), "c_nationkey").alias("cell"), "num")
    specs = inputs.select(F.concat(F.lit("s"), F.substring("cell", 2, 9)).alias("cell"), F.lit("pct_of").alias("shape")).union(spark.createDataFrame([("total", "sum")], "cell string, shape string"))
    own = inputs.select(F.concat(F.lit("s"), F.substring("cell", 2, 9)).alias("cell"), F.inline(F.array(F.struct(F.lit(0).alias("pos"), F.col("cell").alias("needs")), F.struct(F.lit(1).alias("pos"), F.lit("total").alias("needs")))))
    total = inputs.select(F.lit("total").alias("cell"), F.substring("cell", 2, 9).cast("int").alias("pos"), F.col("cell").alias("needs"))
    return levels.evaluate(inputs, specs, own.union(total)).select("cell", F.round("num", 4).alias("num"))


# -------------------------------------------------------------------- publishing
def _page(spark, d) -> DataFrame:
    """Totals by nation (rows) and year (columns) of two measures (sheets)."""
    o = t(spark, d, "orders").join(t(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.groupBy((F.col("c_nationkey") + 1).cast("int").alias("r"), (F.year("o_orderdate") - 1990).cast("int").alias("c")).agg(F.sum(money("o_totalprice")).cast("double").alias("a"), (F.count("*") * 7.0).alias("b"))
    return o.select(F.inline(F.array(F.struct(F.lit("price").alias("sheet"), F.col("a").alias("num")), F.struct(F.lit("count").alias("sheet"), F.col("b").alias("num")))), "r", "c")


PAGE = "o AS (SELECT cast(c_nationkey + 1 AS INTEGER) AS r, cast(year(o_orderdate) - 1990 AS INTEGER) AS c, cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS a, count(*) * 7.0 AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), p AS (SELECT 'price' AS sheet, r, c, a AS num FROM o UNION ALL SELECT 'count', r, c, b FROM o)"


def _printed(page: DataFrame) -> DataFrame:
    """The page's prices as a table printed in thousands."""
    return page.filter("sheet = 'price'").select(F.lit("T").alias("table"), F.col("r").alias("i"), F.col("c").alias("j"), sc.round_half_up(F.col("num") * 0.001, 1).alias("value"), F.lit(1).alias("decimals"))


@query(f"""WITH {PAGE}, asked AS (SELECT 'T' AS tbl, r AS i, c AS j, floor(num * 0.001 * 10 + 0.5) / 10 AS shown, 1 AS decimals FROM p WHERE sheet = 'price'),
place AS (SELECT sheet, r, c, scale, d AS decimals, floor(num * scale * pow(10, d) + 0.5) / pow(10, d) AS shown FROM p, (VALUES (1.0::DOUBLE), (10.0), (100.0), (1000.0), (0.1), (0.01), (0.001)) s(scale), (VALUES (0), (1), (2)) x(d)),
often AS (SELECT sheet, scale, decimals, shown, count(*) AS hits FROM place GROUP BY ALL HAVING count(*) <= 40),
votes AS (SELECT tbl, sheet, scale, i, r, sum(1.0 / hits) AS votes FROM asked JOIN place USING (decimals, shown) JOIN often USING (sheet, scale, decimals, shown) GROUP BY ALL),
best AS (SELECT tbl, sheet, scale, i, max(votes) AS votes FROM votes GROUP BY ALL), score AS (SELECT tbl, sheet, scale, sum(votes) AS votes FROM best GROUP BY ALL)
SELECT tbl AS "table", sheet, scale, round(votes, 6) AS votes FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY round(votes, 9) DESC, sheet, scale) AS n FROM score) WHERE n = 1""")
def value_vote_match(spark, d):
    page = _page(spark, d)
    printed = _printed(page)
    return publish.best_sheet(publish.value_votes(printed, page)).select("table", "sheet", "scale", F.round("votes", 6).alias("votes"))


@query(f"WITH {PAGE}, x AS (SELECT i, j, r, c FROM (SELECT unnest([2, 4, 6]) AS r, unnest([0, 1, 2]) AS i), (SELECT unnest([3, 5, 99]) AS c, unnest([0, 1, 2]) AS j)) SELECT 1 AS page, x.i, x.j, floor(num * 0.001 * (CASE j WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END) + 0.5) / (CASE j WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END) AS value, CASE WHEN num IS NULL THEN NULL WHEN x.r = 4 THEN 'x' ELSE 'v' END AS source FROM x LEFT JOIN (SELECT * FROM p WHERE sheet = 'price') p ON p.r = x.r AND p.c = x.c")
def table_projection(spark, d):
    page = _page(spark, d).withColumn("part", F.lit("p"))
    spec = spark.createDataFrame([(1, "p", "price", 0.001, [0, 1, 2], [2, 4, 6], [3, 5, 99])], "page int, part string, sheet string, scale double, decimals array<int>, rows array<int>, cols array<int>")
    return publish.project_table(spec, page.filter("r <> 4"), page)


SERIES = [(1, 1, "price", 2, 2, 8), (1, 2, "count", 2, 2, 8), (2, 1, "price", 90, 2, 4)]


@query(f"WITH {PAGE}, q(chart, series, sheet, r, c1, c2) AS (VALUES {values(SERIES)}), x AS (SELECT chart, series, q.sheet, q.r, unnest(range(c1, c2 + 1)) AS c FROM q) SELECT chart, series, string_agg(coalesce(cast(cast(round(num) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY x.c) AS shown FROM x LEFT JOIN p ON p.sheet = x.sheet AND p.r = x.r AND p.c = x.c GROUP BY ALL")
def chart_series_long(spark, d):
    got = publish.chart_series(spark.createDataFrame(SERIES, "chart int, series int, sheet string, r int, c1 int, c2 int"), _page(spark, d))
    return got.select("chart", "series", F.array_join(F.transform("values", lambda x: F.coalesce(F.round(x).cast("long").cast("string"), F.lit("-"))), ",").alias("shown"))


@query("SELECT n_regionkey AS chart, n_nationkey AS series, last_value(CASE WHEN n_nationkey % 3 = 0 THEN n_name END IGNORE NULLS) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS UNBOUNDED PRECEDING) AS cat FROM nation")
def chart_cat_inherit(spark, d):
    s = t(spark, d, "nation").select(F.col("n_regionkey").alias("chart"), F.col("n_nationkey").alias("series"), F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).alias("cat"))
    return publish.inherit_categories(s)


@query("WITH x AS (SELECT c_nationkey AS chart, c_mktsegment AS cat, sum(cast(greatest(c_acctbal, 0) AS DECIMAL(18,2))) AS s FROM customer GROUP BY ALL) SELECT chart, round(cast(max(s) AS DOUBLE), 2) AS top FROM x GROUP BY chart")
def stacked_axis_max(spark, d):
    points = t(spark, d, "customer").select(F.col("c_nationkey").alias("chart"), F.col("c_mktsegment").alias("cat"), money("c_acctbal").alias("value"))
    return publish.axis_top(points).select("chart", F.round(F.col("top").cast("double"), 2).alias("top"))


@query("WITH x AS (SELECT l_returnflag AS chart, l_linestatus AS cat, count(*)::DOUBLE AS value FROM lineitem GROUP BY ALL), y AS (SELECT chart, cat, floor(value * 100.0 / sum(value) OVER (PARTITION BY chart) * 10 + 0.5) / 10 AS pct FROM x WHERE value > 0) SELECT chart, cat, pct, pct >= 5 AS labelled FROM y")
def pie_share(spark, d):
    x = t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("chart"), F.col("l_linestatus").alias("cat")).agg(F.count("*").cast("double").alias("value"))
    return publish.pie_shares(x).select("chart", "cat", "pct", "labelled")


@query("SELECT chart, series FROM (SELECT n_regionkey AS chart, n_nationkey AS series, row_number() OVER (PARTITION BY n_regionkey ORDER BY length(n_name) DESC, n_nationkey) AS n FROM nation) WHERE n = 1")
def fullest_categories(spark, d):
    return publish.fullest_categories(t(spark, d, "nation").select(F.col("n_regionkey").alias("chart"), F.col("n_nationkey").alias("series"), F.length("n_name").alias("filled"))).select("chart", "series")


@query("SELECT 'p' AS part, cast(n_regionkey AS VARCHAR) AS sheet, max(CASE WHEN n_nationkey % 3 = 0 THEN n_name END) AS a1, max(CASE WHEN n_nationkey % 3 = 1 THEN n_name END) AS a2, max(CASE WHEN n_nationkey % 3 = 2 THEN n_name END) AS c2 FROM nation GROUP BY 2")
def layout_pivot(spark, d):
    k = F.col("n_nationkey") % 3
    return publish.layout(t(spark, d, "nation").select(F.lit("p").alias("part"), F.col("n_regionkey").cast("string").alias("sheet"), F.when(k == 0, "A1").when(k == 1, "A2").otherwise("C2").alias("ref"), F.col("n_name").alias("txt")))


@query("SELECT cast(sum(o_totalprice_c) AS BIGINT) AS cells, count(*) AS sheets FROM (SELECT o_custkey, cast(arg_min(floor(o_totalprice), o_orderkey) AS BIGINT) AS o_totalprice_c FROM orders GROUP BY 1)")
def dedupe_by_sheet(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor("o_totalprice").alias("cells"))
    return publish.first_of(o, ["o_custkey"], ["o_orderkey"]).agg(F.sum("cells").alias("cells"), F.count("*").alias("sheets"))


@query("SELECT r_name AS part, left(n_name, 1) AS chapter, string_agg(n_name, ',' ORDER BY n_name) AS pages FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def toc_tree(spark, d):
    n = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return publish.toc(n.select(F.col("r_name").alias("part"), F.left("n_name", F.lit(1)).alias("chapter"), F.col("n_name").alias("page"))).select("part", "chapter", F.array_join("pages", ",").alias("pages"))


@query("WITH w AS (SELECT p_partkey, p_brand AS page, p_retailprice AS y FROM part), f AS (SELECT *, CASE WHEN lag(y) OVER s IS NULL OR y - lag(y) OVER s > 2.6 THEN 1 ELSE 0 END AS n FROM w WINDOW s AS (PARTITION BY page ORDER BY y, p_partkey)), l AS (SELECT page, y, max(l) AS line FROM (SELECT page, y, sum(n) OVER (PARTITION BY page ORDER BY y, p_partkey) AS l FROM f) GROUP BY ALL) SELECT page, max(line)::BIGINT AS lines FROM l GROUP BY page")
def pdf_line_grouping(spark, d):
    words = t(spark, d, "part").select(F.col("p_brand").alias("page"), F.col("p_retailprice").alias("y"))
    return tables.lines_of(words, 2.6).groupBy("page").agg(F.max("line").alias("lines"))


@query(f"WITH {MELT}, n AS (SELECT r, count(*) AS n FROM g GROUP BY r) SELECT 'etc' AS src, 'nation' AS sheet, cast(min(r) AS INTEGER) AS header FROM n WHERE n >= 2 AND r <= 10 UNION ALL SELECT 'etc', 'titled', cast(min(r + 2) AS INTEGER) FROM n WHERE n >= 2 AND r + 2 <= 10")
def header_inference(spark, d):
    g = _grid(spark, d)
    titled = g.select("src", F.lit("titled").alias("sheet"), (F.col("r") + 2).alias("r"), "c", "v_num", "v_txt").union(spark.createDataFrame([("etc", "titled", 1, 1, None, "title"), ("etc", "narrow", 1, 1, None, "x")], tables.GRID))
    return tables.header_row(g.union(titled))


@query("SELECT p_brand AS part, max(p_name || '_' || p_partkey) AS path FROM part GROUP BY 1")
def latest_workbook(spark, d):
    return tables.latest(t(spark, d, "part").select(F.col("p_brand").alias("part"), F.concat("p_name", F.lit("_"), "p_partkey").alias("path")))


@query("SELECT l_orderkey, l_linenumber, l_partkey % 99 + 1 AS r, l_suppkey % 60 + 1 AS c FROM lineitem")
def reference_coordinates(spark, d):
    c = F.col("l_suppkey") % 60
    letters = F.concat(F.when(c >= 26, F.char(F.floor(c / 26) + 64)).otherwise(""), F.char(c % 26 + 65))
    ref = F.concat(F.lit("$"), letters, F.lit("$"), F.col("l_partkey") % 99 + 1)
    r, col = tables.coordinates(ref)
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r.cast("long").alias("r"), col.cast("long").alias("c"))


@query("SELECT c_nationkey, c_mktsegment, cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS rows FROM customer GROUP BY ALL")
def totals_by_keys(spark, d):
    from .streaming.refresh import running_totals

    return running_totals(t(spark, d, "customer").withColumn("v", money("c_acctbal")), ["c_nationkey", "c_mktsegment"], "v").withColumn("total", F.col("total").cast("double"))


# ---------------------------------------------------------------------- formulas
def _formulas(spark, d) -> DataFrame:
    p = t(spark, d, "part")
    k = F.col("p_partkey")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("=SUMIFS([1]p1!$D$2:$D$"), k, F.lit(",[1]p1!$A$2:$A$"), k, F.lit(",\"A1 \"\"x\"\"\")")))
        .when(k % 4 == 1, F.concat(F.lit("=_xlfn.NUMBERVALUE(B"), k, F.lit(")/C"), k, F.lit("%")))
        .when(k % 4 == 2, F.concat(F.lit("='sheet "), k, F.lit("'!A1*1000+2.5")))
        .otherwise(F.concat(F.lit("=OFFSET(A"), k, F.lit(",1)&\"년\"")))
    )
    return p.select("p_partkey", text.alias("formula"))


@query("SELECT CASE p_partkey % 4 WHEN 0 THEN '=SUMIFS(@,@,$)' WHEN 1 THEN '=_xlfn.NUMBERVALUE(@)/@%' WHEN 2 THEN '=@*#+#' ELSE '=OFFSET(@,#)&$' END AS shape, count(*) AS n FROM part GROUP BY 1")
def formula_shapes(spark, d):
    from .sources import formulas

    return formulas.shapes(_formulas(spark, d)).select("shape", "n")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'SUMIFS' WHEN 1 THEN 'NUMBERVALUE' WHEN 2 THEN '' ELSE 'OFFSET' END AS used, CASE WHEN p_partkey % 4 = 3 THEN 'unsupported' ELSE 'expr' END AS kind, CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS refs FROM part")
def formula_functions(spark, d):
    from .sources import formulas

    f = F.col("formula")
    return _formulas(spark, d).select("p_partkey", F.array_join(formulas.functions_used(f), ",").alias("used"), formulas.kind(f, "CELL(").alias("kind"), F.size(formulas.references(f)).cast("long").alias("refs"))


@query("SELECT p_partkey, 'host' AS sheet, 4::BIGINT AS r1, 2::BIGINT AS c1, 4::BIGINT AS r2, 102::BIGINT AS c2 FROM part UNION ALL SELECT p_partkey, 'p ' || p_size, 1, 1, p_size, 1 FROM part")
def chart_range_expand(spark, d):
    from .sources import formulas

    text = F.concat(F.lit("($B$4:$CX$4,'p "), "p_size", F.lit("'!$A$1:$A$"), "p_size", F.lit(")"))
    out = t(spark, d, "part").select("p_partkey", F.explode(formulas.areas(text, F.lit("host"))).alias("a"))
    return out.select("p_partkey", "a.sheet", *(F.col(f"a.{k}").cast("long").alias(k) for k in ("r1", "c1", "r2", "c2")))


@query("SELECT o_orderpriority AS \"table\", cast(o_custkey % 5 AS BIGINT) AS j, decimals FROM (SELECT o_orderpriority, o_custkey % 5 AS o_custkey, o_custkey % 3 AS decimals, row_number() OVER (PARTITION BY o_orderpriority, o_custkey % 5 ORDER BY count(*) DESC, min(o_orderkey)) AS n FROM orders GROUP BY 1, 2, 3) WHERE n = 1")
def usual_decimals(spark, d):
    k = F.col("o_custkey")
    text = F.when(k % 3 == 0, "1,234").when(k % 3 == 1, "12.5").otherwise("0.25")
    shown = t(spark, d, "orders").select(F.col("o_orderpriority").alias("table"), F.col("o_orderkey").alias("i"), (k % 5).alias("j"), text.alias("text"))
    return publish.usual_decimals(shown).select("table", "j", F.col("decimals").cast("long").alias("decimals"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 <> 0 THEN -1.0::DOUBLE ELSE c_acctbal END AS num FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def computed_before_constants(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("num"))
    constants = c.filter("c_custkey % 3 = 0").withColumn("num", F.lit(-1.0))
    return publish.prefer(c.filter("c_custkey % 2 = 0"), constants, ["c_custkey"], ["num"])


@query("SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE contains(lower(n_name || ' ' || r_name), 'a')")
def search_pages(spark, d):
    n = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return publish.search(n, "A", ["n_name", "r_name"]).select("n_nationkey", "n_name")


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT cell, needs AS leaf FROM e UNION SELECT r.cell, e.needs FROM r JOIN e ON r.leaf = e.cell) SELECT leaf, count(*) AS users FROM r WHERE leaf NOT IN (SELECT cell FROM e) GROUP BY leaf")
def leaf_users(spark, d):
    return levels.leaves(_edges(spark, d)).groupBy("leaf").agg(F.count("*").alias("users"))


# ------------------------------------------------- printed tables, whole matching
HITS = f"""{PAGE}, asked AS (SELECT 'T' AS tbl, r AS i, c AS j, floor(num * 0.001 * 10 + 0.5) / 10 AS shown, 1 AS decimals FROM p WHERE sheet = 'price'),
place AS (SELECT sheet, r, c, scale, d AS decimals, floor(num * scale * pow(10, d) + 0.5) / pow(10, d) AS shown FROM p, (VALUES (1.0::DOUBLE), (10.0), (100.0), (1000.0), (0.1), (0.01), (0.001)) s(scale), (VALUES (0), (1), (2)) x(d)),
often AS (SELECT sheet, scale, decimals, shown, count(*) AS hits FROM place GROUP BY ALL HAVING count(*) <= 40),
hit AS (SELECT tbl, sheet, scale, i, j, r, c, hits FROM asked JOIN place USING (decimals, shown) JOIN often USING (sheet, scale, decimals, shown))"""


def _greedy_sql(name: str, line: str, to: str) -> str:
    """Each printed line in turn, the one with the strongest vote first, takes its strongest free one: a recursion over lines."""
    return f"""{name}_v AS (SELECT sheet, scale, {line} AS line, {to} AS place, round(sum(1.0 / hits), 9) AS v FROM hit GROUP BY ALL),
{name}_l AS (SELECT sheet, scale, line, max(v) AS best, list(place ORDER BY v DESC, place) AS places FROM {name}_v GROUP BY ALL),
{name}_g AS (SELECT sheet, scale, list(line ORDER BY best DESC, line) AS lines, list(places ORDER BY best DESC, line) AS places FROM {name}_l GROUP BY ALL),
{name}_a AS (SELECT sheet, scale, 1 AS k, []::INTEGER[] AS used, []::INTEGER[] AS got, lines, places FROM {name}_g
UNION ALL SELECT sheet, scale, k + 1, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick) END, list_append(got, pick), lines, places FROM (SELECT *, list_filter(places[k], lambda x: NOT list_contains(used, x))[1] AS pick FROM {name}_a WHERE k <= len(lines))),
{name} AS (SELECT * FROM (SELECT sheet, scale, unnest(lines) AS {line}, unnest(got) AS {to} FROM {name}_a WHERE k = len(lines) + 1) WHERE {to} IS NOT NULL)"""


@query(f"WITH RECURSIVE {HITS}, {_greedy_sql('rowmap', 'i', 'r')} SELECT 'T' AS \"table\", sheet, scale, i, r FROM rowmap")
def greedy_assignment(spark, d):
    page = _page(spark, d)
    return publish.greedy_pairs(publish.value_votes(_printed(page), page)).select("table", "sheet", "scale", "i", "r")


ALIGNED = f"""{HITS}, {_greedy_sql('rowmap', 'i', 'r')}, {_greedy_sql('colmap', 'j', 'c')},
laid AS (SELECT m.sheet, m.scale, floor(num * m.scale * 10 + 0.5) / 10 = shown AS same FROM rowmap m JOIN colmap n ON m.sheet = n.sheet AND m.scale = n.scale JOIN asked ON asked.i = m.i AND asked.j = n.j LEFT JOIN p ON p.sheet = m.sheet AND p.r = m.r AND p.c = n.c),
checked AS (SELECT sheet, scale, count(*) AS pairs, count(*) FILTER (WHERE same) AS matched FROM laid GROUP BY ALL),
rising AS (SELECT sheet, scale, CASE WHEN bool_and(coalesce(up, true)) THEN 0.5 ELSE 0 END AS bonus FROM (SELECT sheet, scale, r > lag(r) OVER (PARTITION BY sheet, scale ORDER BY i) AS up FROM rowmap) GROUP BY ALL UNION ALL SELECT sheet, scale, CASE WHEN bool_and(coalesce(up, true)) THEN 0.5 ELSE 0 END FROM (SELECT sheet, scale, c > lag(c) OVER (PARTITION BY sheet, scale ORDER BY j) AS up FROM colmap) GROUP BY ALL),
scored AS (SELECT sheet, scale, pairs, matched, round(matched / pairs, 3) AS rate, matched / pairs * 100 + matched + (SELECT sum(bonus) FROM rising x WHERE x.sheet = checked.sheet AND x.scale = checked.scale) AS score FROM checked),
best AS (SELECT *, CASE WHEN rate >= 0.9 AND matched >= 4 THEN 'ok' WHEN rate >= 0.7 AND matched >= 3 THEN 'weak' ELSE 'fail' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY score DESC, list_position([1.0, 10.0, 100.0, 1000.0, 0.1, 0.01, 0.001], scale)) AS n FROM scored) WHERE n = 1)"""


@query(f"WITH RECURSIVE {ALIGNED} SELECT 'T' AS \"table\", sheet, scale, rate, pairs, matched, round(score, 6) AS score, status FROM best")
def printed_alignment(spark, d):
    page = _page(spark, d)
    return publish.align(_printed(page), page).select("table", "sheet", "scale", "rate", "pairs", "matched", F.round("score", 6).alias("score"), "status")


@query(f"WITH RECURSIVE {ALIGNED} SELECT 'T' AS \"table\", sheet, scale, (SELECT string_agg(r, ',' ORDER BY i) FROM rowmap m WHERE m.sheet = best.sheet AND m.scale = best.scale) AS rows, (SELECT string_agg(c, ',' ORDER BY j) FROM colmap m WHERE m.sheet = best.sheet AND m.scale = best.scale) AS cols, (SELECT string_agg('year ' || (j + 1990), ',' ORDER BY j) FROM colmap m WHERE m.sheet = best.sheet AND m.scale = best.scale) AS head, (SELECT string_agg('nation ' || (i - 1), ',' ORDER BY i) FROM rowmap m WHERE m.sheet = best.sheet AND m.scale = best.scale) AS labels, (SELECT string_agg('1', ',') FROM colmap m WHERE m.sheet = best.sheet AND m.scale = best.scale) AS decimals, 'corner' AS corner FROM best WHERE status <> 'fail'")
def printed_table_spec(spark, d):
    page = _page(spark, d)
    printed = _printed(page)
    side = page.select("r").distinct().select(F.col("r").alias("i"), F.lit(4).alias("j"), F.concat(F.lit("nation "), F.col("r") - 1).alias("text"))
    top = page.select("c").distinct().select(F.lit(0).alias("i"), F.col("c").alias("j"), F.concat(F.lit("year "), F.col("c") + 1990).alias("text"))
    texts = printed.select("i", "j", F.format_number("value", 1).alias("text")).union(side).union(top).union(spark.createDataFrame([(0, 4, "corner")], "i int, j int, text string"))
    out = publish.table_spec(publish.align(printed, page), texts.select(F.lit("T").alias("table"), "i", "j", "text"))
    return out.select("table", "sheet", "scale", *(F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("rows", "cols", "head", "labels", "decimals")), "corner")


# --------------------------------------------------------- long chains, and cycles
def _chains(spark, d) -> DataFrame:
    """Parts of a brand as chains: each needs the one before it."""
    before = F.lag("p_partkey").over(ranking.W.partitionBy("p_brand").orderBy("p_partkey"))
    return t(spark, d, "part").select(F.col("p_partkey").alias("cell"), before.alias("needs"))


@query("SELECT p_partkey AS cell, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS level FROM part UNION ALL SELECT -1 - s_suppkey, NULL FROM supplier")
def deep_chain_levels(spark, d):
    # Suppliers need each other, two by two.
    k = F.col("s_suppkey")
    rings = t(spark, d, "supplier").select((-1 - k).alias("cell"), (-2 - k + 2 * (k % 2)).alias("needs"))
    both = _chains(spark, d).union(rings)
    return levels.levels(both.select("cell"), both.filter("needs is not null"))


@query("SELECT cell, leaf FROM (SELECT p_partkey AS cell, min(p_partkey) OVER (PARTITION BY p_brand) AS leaf FROM part) WHERE cell <> leaf")
def deep_closure(spark, d):
    return levels.leaves(_chains(spark, d).filter("needs is not null"))


@query("""WITH n AS (SELECT n_nationkey AS k, n_name FROM nation)
SELECT 'shown' || k AS cell, NULL::DOUBLE AS num, n_name || ':' || cast(k AS VARCHAR) AS txt, false AS on_cycle FROM n
UNION ALL SELECT 'dash' || k, CASE WHEN k <> 0 THEN k END, CASE WHEN k = 0 THEN '-' END, false FROM n
UNION ALL SELECT 'half' || k, NULL, format('{:.1f}', k / 2), false FROM n
UNION ALL SELECT 'big' || k, NULL, CASE WHEN k > 12 THEN n_name ELSE 'small' END, false FROM n
UNION ALL SELECT 'loop' || k, NULL, NULL, true FROM n
UNION ALL SELECT 'max', max(k), NULL, false FROM n UNION ALL SELECT 'filled', count(*), NULL, false FROM n UNION ALL SELECT 'strict', NULL, NULL, false UNION ALL SELECT 'safe', 7, NULL, false""")
def formula_shapes_evaluated(spark, d):
    n = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("k"), F.col("n_nationkey").cast("double").alias("num"), "n_name")
    none = F.lit(None)
    given = lambda cell, num, txt: n.select(cell.alias("cell"), num.cast("double").alias("num"), txt.cast("string").alias("txt"))
    name = lambda p: F.concat(F.lit(p), "k")
    fixed = spark.createDataFrame([(":", None, ":"), ("2", 2.0, None), ("1", 1.0, None), ("12", 12.0, None), ("7", 7.0, None), ("small", None, "small")], "cell string, num double, txt string")
    inputs = given(name("num"), F.col("num"), none).union(given(name("txt"), none, F.col("n_name"))).union(fixed)
    cells = {"shown": ("concat", "txt{}", ":", "num{}"), "dash": ("zero_dash", "num{}"), "_h": ("div", "num{}", "2"), "half": ("text", "_h{}", "1"), "_c": ("cmp >", "num{}", "12"), "big": ("if", "_c{}", "txt{}", "small"), "loop": ("ref", "loop{}")}
    put = lambda x: F.concat(F.lit(x[:-2]), "k") if x.endswith("{}") else F.lit(x)
    specs = n.select(F.inline(F.array(*(F.struct(name(p).alias("cell"), F.lit(s[0]).alias("shape")) for p, s in cells.items()))))
    edges = n.select(F.inline(F.array(*(F.struct(name(p).alias("cell"), F.lit(i).alias("pos"), put(x).alias("needs")) for p, s in cells.items() for i, x in enumerate(s[1:])))))
    one = spark.createDataFrame([("max", "max"), ("filled", "counta"), ("strict", "add"), ("safe", "iferror")], "cell string, shape string")
    over = lambda p, *to: n.select(F.explode(F.array(*map(F.lit, to))).alias("cell"), F.col("num").cast("int").alias("pos"), name(p).alias("needs"))
    edges = edges.union(over("num", "max")).union(over("txt", "filled", "strict")).union(spark.createDataFrame([("safe", 0, "strict"), ("safe", 1, "7")], "cell string, pos int, needs string"))
    out = levels.evaluate(inputs, specs.union(one), edges)
    return out.join(inputs.select("cell"), "cell", "left_anti").filter("cell not like '\\_%'")


# ------------------------------------------------- lookups and ranges within pages
@query(f"WITH {MELT}, q(qid, needle) AS (VALUES {values(NEEDLES)}), h AS (SELECT qid, min(r) AS r FROM q LEFT JOIN g ON c = 2 AND r BETWEEN 2 AND 20 AND trim(upper(v_txt)) = trim(upper(needle)) GROUP BY qid) SELECT qid, v_num AS num, v_txt AS txt, NULL::DOUBLE AS outside FROM h LEFT JOIN g ON h.r = g.r AND g.c = 3")
def page_vlookup(spark, d):
    page = _grid(spark, d).select(F.lit("p").alias("part"), "sheet", "r", "c", F.col("v_num").alias("num"), F.col("v_txt").alias("txt"))
    q = _needles(spark, NEEDLES).select("qid", F.lit("p").alias("part"), "sheet", F.lit(2).alias("r1"), F.lit(2).alias("c1"), F.lit(20).alias("r2"), F.lit(3).alias("c2"), F.lit(2).alias("index"), F.lit(None).cast("double").alias("num"), F.concat(F.lit(" "), "needle").alias("txt"))
    outside = lookups.page_lookup(q.withColumn("index", F.lit(3)), page, "r").select("qid", F.col("num").alias("outside"))
    return lookups.page_lookup(q, page, "r").join(outside, "qid")


@query("SELECT cast(n_regionkey AS INTEGER) AS qid, cast(sum(n_nationkey) + 1000 AS DOUBLE) AS total, 1000.0::DOUBLE AS largest, 2 * count(*) + 1 AS filled FROM nation GROUP BY 1")
def range_and_value_arguments(spark, d):
    n = t(spark, d, "nation")
    r = F.row_number().over(ranking.W.partitionBy("n_regionkey").orderBy("n_nationkey"))
    cells = n.select(F.lit("p").alias("part"), F.col("n_regionkey").cast("string").alias("sheet"), r.alias("r"), F.inline(F.array(F.struct(F.lit(1).alias("c"), F.col("n_nationkey").cast("double").alias("num"), F.lit(None).cast("string").alias("txt")), F.struct(F.lit(2).alias("c"), F.lit(None).cast("double").alias("num"), F.col("n_name").alias("txt")))))
    asked = n.select(F.col("n_regionkey").cast("int").alias("qid"), F.col("n_regionkey").cast("string").alias("sheet")).distinct()
    rect = asked.select("qid", F.lit("p").alias("part"), "sheet", F.lit(1).alias("r1"), F.lit(1).alias("c1"), F.lit(1000).alias("r2"), F.lit(2).alias("c2"))
    return ranges.range_aggregates(rect, cells, asked.select("qid", F.lit(1000.0).alias("num"), F.lit(None).cast("string").alias("txt")))


@query("SELECT p_partkey, p_partkey % 99 + 1 AS own, 5::BIGINT AS fixed FROM part")
def own_row(spark, d):
    ref = F.concat(F.lit("B"), F.col("p_partkey") % 99 + 1)
    return t(spark, d, "part").select("p_partkey", tables.own_row(ref).cast("long").alias("own"), tables.own_row(ref, 5).cast("long").alias("fixed"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey < n_regionkey THEN 'before' WHEN n_nationkey = n_regionkey THEN 'at' ELSE 'after' END AS place, CASE WHEN n_regionkey % 2 = 0 THEN n_name ELSE NULL END AS txt, CASE WHEN n_regionkey % 2 = 1 THEN n_nationkey * 10.0 ELSE cast(n_nationkey AS DOUBLE) END AS num FROM nation")
def deref_computed_first(spark, d):
    n = t(spark, d, "nation")
    at = [F.lit("p").alias("part"), F.lit("s").alias("sheet"), F.col("n_nationkey").alias("r"), F.lit(1).alias("c")]
    page = n.select(*at, F.col("n_nationkey").cast("double").alias("num"), F.col("n_name").alias("txt"))
    computed = n.filter("n_regionkey % 2 = 1").select(*at, (F.col("n_nationkey") * 10.0).alias("num"), F.lit(None).cast("string").alias("txt"))
    place = F.when(F.col("n_nationkey") < F.col("n_regionkey"), "before").when(F.col("n_nationkey") == F.col("n_regionkey"), "at").otherwise("after")
    return lookups.deref(n.select("n_nationkey", place.alias("place"), *at), page, computed).select("n_nationkey", "place", "num", "txt")


# -------------------------------------------------------------- more of publishing
@query("SELECT 'p' AS part, n_regionkey AS sheet, n_nationkey AS ref FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 = 0")
def required_cells(spark, d):
    at = t(spark, d, "nation").select(F.lit("p").alias("part"), F.col("n_regionkey").alias("sheet"), F.col("n_nationkey").alias("ref"))
    leaves = at.filter("ref % 2 = 0")
    return publish.required_cells(leaves.union(leaves), at, at.filter("ref % 2 <> 0 and ref % 3 <> 0"))


@query("SELECT p_brand AS page, p_size AS \"table\", count(*) AS n FROM part JOIN (SELECT p_brand AS b, min(p_size) AS s FROM (SELECT p_brand, p_size, string_agg(p_name, ',' ORDER BY p_partkey) AS names FROM part GROUP BY ALL) GROUP BY p_brand, names) ON b = p_brand AND s = p_size GROUP BY ALL")
def distinct_tables(spark, d):
    rows = t(spark, d, "part").select(F.col("p_brand").alias("page"), F.col("p_size").alias("table"), F.array("p_name").alias("cells"), "p_partkey")
    rows = rows.withColumn("i", F.row_number().over(ranking.W.partitionBy("page", "table").orderBy("p_partkey")))
    return publish.distinct_tables(rows).groupBy("page", "table").agg(F.count("*").alias("n"))


@query("WITH l AS (SELECT c_nationkey AS chart, c_mktsegment AS label, c_custkey % 2 AS color, min(c_custkey) AS pos FROM customer GROUP BY ALL) SELECT * FROM l WHERE chart IN (SELECT chart FROM l GROUP BY chart HAVING count(*) >= 2)")
def legend_entries(spark, d):
    c = t(spark, d, "customer").select(F.col("c_nationkey").alias("chart"), F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("label"), (F.col("c_custkey") % 2).alias("color"))
    return publish.legend(c.union(c.withColumn("label", F.lit(""))))


@query("WITH l AS (SELECT o_orderpriority AS sheet, o_custkey AS ref, count(DISTINCT o_orderkey) AS users FROM orders GROUP BY ALL) SELECT sheet, count(*) AS n_leaves, cast(sum(users) AS BIGINT) AS users, arg_max(ref, users * 1e9 - ref) AS top, count(*) FILTER (WHERE ref BETWEEN 1960 AND 2100) AS years, count(*) FILTER (WHERE ref <= 100) AS small FROM l GROUP BY sheet")
def literal_dependencies(spark, d):
    o = t(spark, d, "orders").select(F.lit("p").alias("part"), F.col("o_orderpriority").alias("sheet"), F.col("o_custkey").alias("ref"), F.col("o_orderkey").alias("cell"))
    known = o.select("part", "sheet", "ref", F.col("ref").cast("double").alias("num"), F.lit(None).cast("string").alias("txt")).distinct()
    of = lambda kind: F.size(F.filter("cells", lambda x: x["kind"] == kind)).cast("long")
    return publish.literal_dependencies(o, known).select("sheet", "n_leaves", "users", F.get("cells", F.lit(0))["ref"].alias("top"), of("year").alias("years"), of("small number").alias("small"))


@query(f"WITH {VERDICTS}, c AS (SELECT count(DISTINCT part) AS parts, count(*) FILTER (WHERE verdict IN ('match', 'mismatch', 'error', 'known-divergence')) AS cells FROM v) SELECT 'cells: ' || cells || ', at least 1000 expected' AS violation FROM c WHERE cells < 1000 UNION ALL SELECT 'parts: ' || parts || ', at least 99 expected' FROM c WHERE parts < 99")
def floor_violations(spark, d):
    found = verification.floor_violations(verification.rates(_verdicts(spark, d)), verification.Floor(99, 1000))
    return spark.createDataFrame([(x,) for x in found], "violation string")


@query("WITH s AS (SELECT n_nationkey AS k, n_name FROM nation) SELECT 'p' AS part, 's' AS sheet, k AS ref, CASE WHEN k % 3 = 0 THEN 'match' WHEN k % 3 = 1 AND k % 4 <> 1 THEN 'known-divergence' ELSE 'mismatch' END AS verdict FROM s")
def exemptions_of_texts(spark, d):
    n = t(spark, d, "nation").select(F.lit("p").alias("part"), F.lit("s").alias("sheet"), F.col("n_nationkey").alias("ref"), "n_name")
    none, k = F.lit(None).cast("double"), F.col("ref")
    r = n.select("part", "sheet", "ref", F.when(k % 3 == 0, "match").otherwise("mismatch").alias("verdict"), none.alias("e_num"), F.col("n_name").alias("e_txt"), none.alias("g_num"), F.concat("n_name", F.lit("?")).alias("g_txt"))
    x = r.filter("ref % 3 <> 2").select("part", "sheet", "ref", "e_num", "e_txt", "g_num", F.when(k % 4 == 1, "other").otherwise(F.col("g_txt")).alias("g_txt"))
    return verification.exempt(r, x.union(x)).select("part", "sheet", "ref", "verdict")


@query("SELECT o_orderpriority AS \"table\", count(*) AS n_rows, 4 AS n_cols FROM orders GROUP BY 1")
def data_tables(spark, d):
    o = t(spark, d, "orders")
    rows = o.select(F.col("o_orderpriority").alias("table"), F.col("o_orderkey").alias("i"), F.array(F.col("o_orderkey").cast("string"), F.format_number("o_totalprice", 1), F.lit(""), F.col("o_orderstatus")).alias("cells"))
    labels = o.select(F.concat("o_orderpriority", F.lit(" (labels)")).alias("table"), F.col("o_orderkey").alias("i"), F.array("o_orderstatus", "o_orderpriority", F.lit("7")).alias("cells"))
    return publish.data_table(rows.union(labels)).select("table", "n_rows", "n_cols")


@query(f"WITH {PAGE} SELECT r AS page, count(*) FILTER (WHERE sheet = 'price') AS cells, count(DISTINCT sheet) AS charts FROM p GROUP BY r")
def page_bundles(spark, d):
    page = _page(spark, d)
    charts = page.groupBy(F.col("r").alias("page"), F.col("sheet").alias("chart")).agg(F.lit(1).alias("series"), F.sort_array(F.collect_list("num")).alias("values"))
    cells = page.filter("sheet = 'price'").select(F.col("r").alias("page"), F.lit(0).alias("i"), F.col("c").alias("j"), F.col("num").alias("value"), F.lit("v").alias("source"))
    out = publish.bundle(page.select(F.col("r").alias("page")).distinct(), charts, cells)
    size = lambda path: F.coalesce(F.json_array_length(F.get_json_object("document", path)), F.lit(0)).cast("long")
    return out.select("page", size("$.cells").alias("cells"), size("$.charts").alias("charts"))


# ------------------------------------------------------------------------- loaders
@query("SELECT 'kosis' AS src, 'orders' AS table_id, o_orderpriority AS itm_nm, cast(year(o_orderdate) AS VARCHAR) AS prd_de, count(*) AS n, cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL")
def loaded_observations(spark, d):
    """Orders as JSON lines of observations, loaded back."""
    o = t(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("PRD_DE"), F.col("o_orderpriority").alias("ITM_NM"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("DT"))
    path = scratch.json_lines(o.union(o.limit(1).select(F.lit(None).cast("string"), "ITM_NM", "DT")), "orders")
    return tables.load_obs(spark, path, "kosis").groupBy("src", "table_id", "itm_nm", "prd_de").agg(F.count("*").alias("n"), F.sum(money("dt")).cast("double").alias("total"))


@query("SELECT 'rates' AS table_id, n_name AS ref_area, 2024::VARCHAR AS period, CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey * 1.5 END::DOUBLE AS value, NULL::VARCHAR AS sex FROM nation")
def loaded_international(spark, d):
    """Nations as sparse JSON lines of an international table, loaded back: absent columns are null, numbers as periods are texts."""
    n = t(spark, d, "nation").select(F.col("n_name").alias("REF_AREA"), F.lit(2024).alias("TIME_PERIOD"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey") * 1.5).alias("value"))
    return tables.load_oecd(spark, scratch.json_lines(n, "rates")).select("table_id", F.col("REF_AREA").alias("ref_area"), F.col("TIME_PERIOD").alias("period"), "value", F.col("SEX").alias("sex"))


@query("SELECT 'etc' AS src, 'sheet' AS sheet, cast(n_nationkey AS INTEGER) AS r, 1 AS c, cast(n_nationkey AS DOUBLE) + 0.5 AS v_num, NULL::VARCHAR AS v_txt FROM nation UNION ALL SELECT 'etc', 'sheet', n_nationkey, 2, NULL, n_name FROM nation UNION ALL SELECT 'etc', 'sheet', n_nationkey, 3, NULL, '202508' FROM nation")
def loaded_grid(spark, d):
    """Cells as JSON lines, loaded back: texts of digits stay texts, blank cells are left out."""
    n = t(spark, d, "nation")
    cell = lambda c, v: n.select(F.to_json(F.struct(F.col("n_nationkey").alias("r"), F.lit(c).alias("c"), v.alias("v"))).alias("value"))
    lines = cell(1, F.col("n_nationkey") + 0.5).union(cell(2, F.col("n_name"))).union(cell(3, F.lit("202508"))).union(cell(4, F.lit("  ")))
    return tables.load_grid(spark, scratch.text_lines(lines, "sheet"), "etc")


# ------------------------------------------------------ criteria, needles, reasons
@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN cast(2000 + n_nationkey AS VARCHAR) ELSE n_name END AS year, CASE WHEN n_nationkey % 3 = 0 THEN 'unresolved year' END AS year_err, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN cast(2000 + n_nationkey AS VARCHAR) ELSE ' ' || n_name || '~* ' END AS cell, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN cast(2000 + n_nationkey AS VARCHAR) ELSE ' ' || n_name || '* ' END AS expr, CASE WHEN n_nationkey % 3 = 0 THEN 'unresolved expr' END AS expr_err FROM nation")
def criterion_values(spark, d):
    k = F.col("n_nationkey") % 3
    escaped = sc.cell(F.when(k == 1, F.col("n_nationkey") + 2000), F.when(k == 2, F.concat(F.lit(" "), "n_name", F.lit("~* "))))
    plain = sc.cell(F.when(k == 1, F.col("n_nationkey") + 2000), F.when(k == 2, F.concat(F.lit(" "), "n_name", F.lit(" "))))
    out = t(spark, d, "nation").select("n_nationkey", cr.value_of("year", plain).alias("y"), cr.value_of("cell", escaped).alias("c"), cr.value_of("expr", escaped).alias("e"))
    return out.select("n_nationkey", F.col("y.text").alias("year"), F.col("y.err").alias("year_err"), F.col("c.text").alias("cell"), F.col("e.text").alias("expr"), F.col("e.err").alias("expr_err"))


PATTERNS = [(1, "FRANCE"), (2, "FRAN*"), (3, "N?TION_7"), (4, "nation~~_3"), (5, "~*")]


@query(f"WITH {MELT}, q(qid, needle) AS (VALUES {values(PATTERNS)}), h AS (SELECT qid, min(r) AS r FROM q LEFT JOIN g ON c = 2 AND lower(v_txt) = lower(needle) AND NOT regexp_matches(needle, '[*?~]') GROUP BY qid) SELECT qid, v_num AS num, v_txt AS txt FROM h LEFT JOIN g ON h.r = g.r AND g.c = 3")
def vlookup_refuses_patterns(spark, d):
    return lookups.vlookup(_needles(spark, PATTERNS), _grid(spark, d), 2, 2)


@query("SELECT CASE event_id % 3 WHEN 0 THEN 'no column' WHEN 1 THEN 'unknown function: ' || event_type ELSE 'row # of ' || event_type END AS key, count(*) AS n, min(event_id) AS sample FROM events GROUP BY 1")
def reasons_with_noisy_tails(spark, d):
    k = F.col("event_id") % 3
    reason = F.when(k == 0, F.concat(F.lit("no column: ['"), "event_type", F.lit("', "), "user_id", F.lit("] (sheet p"), "user_id", F.lit(")"))).when(k == 1, F.concat(F.lit("unknown function: "), "event_type")).otherwise(F.concat(F.lit("row "), "user_id", F.lit(" of "), "event_type"))
    return verification.reason_groups(t(spark, d, "events").select("event_id", reason.alias("reason")), "reason", "event_id")


@query("SELECT n_nationkey AS chart, CASE WHEN n_nationkey % 4 = 0 THEN 'r' ELSE 'l' END AS axis FROM nation")
def secondary_axes(spark, d):
    k = F.col("n_nationkey")
    groups = t(spark, d, "nation").select(k.alias("chart"), F.lit(1).alias("grp"), F.array(F.lit("cat"), F.lit("a"), F.when(k % 2 == 0, "b").otherwise("none")).alias("ids"))
    axes = t(spark, d, "nation").select(k.alias("chart"), F.inline(F.array(F.struct(F.lit("cat").alias("id"), F.lit("catAx").alias("type"), F.lit("r").alias("pos")), F.struct(F.lit("a").alias("id"), F.lit("valAx").alias("type"), F.lit(None).cast("string").alias("pos")), F.struct(F.lit("b").alias("id"), F.lit("valAx").alias("type"), F.when(k % 4 == 0, "r").otherwise("l").alias("pos")))))
    return publish.value_axes(groups, axes).select("chart", "axis")


@query("SELECT r_name AS part, string_agg(shown, ';' ORDER BY first) AS chapters FROM (SELECT r_name, ch, min(n_nationkey) AS first, ch || ':' || string_agg(n_name, ',' ORDER BY sec_first, n_nationkey) AS shown FROM (SELECT r_name, left(n_name, 1) AS ch, n_name, n_nationkey, min(n_nationkey) OVER (PARTITION BY r_name, left(n_name, 1), coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'even' END, '')) AS sec_first FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY r_name, ch) GROUP BY r_name")
def contents_tree(spark, d):
    n = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    pages = n.select(F.col("n_nationkey").alias("pos"), F.col("r_name").alias("part"), F.left("n_name", F.lit(1)).alias("chapter"), F.when(F.col("n_nationkey") % 2 == 0, "even").alias("section"), F.col("n_name").alias("page"))
    line = lambda c: F.concat(c["chapter"], F.lit(":"), F.array_join(F.flatten(F.transform(c["sections"], lambda s: s["pages"])), ","))
    return publish.tree(pages).select("part", F.array_join(F.transform("chapters", line), ";").alias("chapters"))


from . import catalogue_bulk  # noqa: E402, F401  (its queries need the helpers above)
