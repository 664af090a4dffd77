"""Queries over criteria tables, long lines, many ranges and damaged files, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import money, query, t
from .functions import scalars as sc
from .operators import bulk, lookups, ranges, scans, verification
from .plans import levels
from .sources import scratch, store, tables

# ------------------------------------------------------------- criteria in bulk
#: A question per customer; the criteria are strings of all kinds.
LONG_QUESTIONS = """q AS (SELECT c_custkey AS qid,
CASE c_custkey % 6 WHEN 0 THEN 'f' WHEN 1 THEN '<>o' WHEN 2 THEN '<>' WHEN 3 THEN '=' WHEN 4 THEN '=P' END AS status,
CASE c_custkey % 5 WHEN 0 THEN '<>1-URGENT' WHEN 1 THEN '=5-low' WHEN 2 THEN '<3' WHEN 3 THEN '<>none' END AS priority,
CASE c_custkey % 4 WHEN 0 THEN '<>' || c_custkey WHEN 1 THEN '' || c_custkey WHEN 2 THEN '>=' || c_custkey WHEN 3 THEN '<' || c_custkey END AS customer FROM customer)"""
PICK = """SELECT qid, status, priority, customer, o_totalprice FROM q LEFT JOIN orders ON
(status IS NULL OR CASE status WHEN 'f' THEN lower(o_orderstatus) = 'f' WHEN '<>o' THEN lower(o_orderstatus) <> 'o' WHEN '<>' THEN o_orderstatus <> '' WHEN '=' THEN o_orderstatus = '' ELSE lower(o_orderstatus) = 'p' END)
AND (priority IS NULL OR CASE priority WHEN '<>1-URGENT' THEN o_orderpriority <> '1-URGENT' WHEN '=5-low' THEN o_orderpriority = '5-LOW' WHEN '<3' THEN CAST(left(o_orderpriority, 1) AS INTEGER) < 3 ELSE true END)
AND CASE qid % 4 WHEN 0 THEN o_custkey <> qid WHEN 1 THEN o_custkey = qid WHEN 2 THEN o_custkey >= qid ELSE o_custkey < qid END"""


def _long_questions(spark, d):
    k = F.col("c_custkey")
    case = lambda n, *v: F.get(F.array(*(F.lit(x) if isinstance(x, str) or x is None else x for x in v)), (k % n).cast("int"))
    s = k.cast("string")
    customer = case(4, F.concat(F.lit("<>"), s), s, F.concat(F.lit(">="), s), F.concat(F.lit("<"), s))
    return t(spark, d, "customer").select(k.alias("qid"), case(6, "f", "<>o", "<>", "=", "=P", None).alias("status"), case(5, "<>1-URGENT", "=5-low", "<3", "<>none", None).alias("priority"), customer.alias("customer"))


def _long_fields():
    return {"status": bulk.Field("text", txt=F.col("o_orderstatus")), "priority": bulk.Field("text", txt=F.col("o_orderpriority")), "customer": bulk.Field("number", F.col("o_custkey"))}


@query(f"WITH {LONG_QUESTIONS} SELECT qid, coalesce(cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS value FROM ({PICK}) GROUP BY qid")
def criteria_bulk_long(spark, d):
    got = bulk.answer(t(spark, d, "orders"), _long_questions(spark, d), _long_fields(), money("o_totalprice"))
    return got.select("qid", F.col("value").cast("double").alias("value"))


@query("""WITH q AS (SELECT c_custkey AS qid, CASE c_custkey % 3 WHEN 0 THEN '<>' || lower(c_mktsegment) WHEN 1 THEN c_mktsegment ELSE '<>' END AS segment, '<>' || c_nationkey AS nation FROM customer)
SELECT qid, round(cast(sum(cast(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(c.c_acctbal), 0), 4) AS value FROM q JOIN customer c ON '<>' || c.c_nationkey <> nation
AND CASE qid % 3 WHEN 0 THEN '<>' || lower(c.c_mktsegment) <> segment WHEN 1 THEN c.c_mktsegment = segment ELSE c.c_mktsegment <> '' END GROUP BY qid""")
def criteria_bulk_means(spark, d):
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    c = t(spark, d, "customer")
    q = c.select(k.alias("qid"), F.get(F.array(F.concat(F.lit("<>"), F.lower(segment)), segment, F.lit("<>")), (k % 3).cast("int")).alias("segment"), F.concat(F.lit("<>"), "c_nationkey").alias("nation"))
    fields = {"segment": bulk.Field("text", txt=segment), "nation": bulk.Field("number", F.col("c_nationkey"))}
    return bulk.answer(c, q, fields, money("c_acctbal"), "mean").select("qid", F.round("value", 4).alias("value"))


GRID_QUESTIONS = """p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part),
q AS (SELECT p_partkey AS qid, p_brand, CASE p_partkey % 4 WHEN 0 THEN '<>' || p_size WHEN 1 THEN '' || p_size WHEN 2 THEN '>' || p_size ELSE '<>' END AS size, CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN '<>' || p_type ELSE '=' END AS kind FROM part)"""
GRID_PICK = """q LEFT JOIN p ON p.p_brand = q.p_brand AND
CASE p.p_partkey % 5 WHEN 0 THEN qid % 4 = 0 ELSE CASE qid % 4 WHEN 0 THEN '<>' || p_size <> size WHEN 1 THEN '' || p_size = size WHEN 2 THEN p_size > CAST(substr(size, 2) AS INTEGER) ELSE true END END AND
CASE p.p_partkey % 7 WHEN 0 THEN qid % 3 <> 0 ELSE CASE qid % 3 WHEN 0 THEN lower(p_type) = kind WHEN 1 THEN '<>' || p_type <> kind ELSE false END END"""


def _brand_sheets(spark, d):
    """A sheet per brand; every fifth part has no size, every seventh no type."""
    p = t(spark, d, "part").withColumn("r", F.row_number().over(scans.W.partitionBy("p_brand").orderBy("p_partkey")))
    num, txt = lambda c, x: F.struct(F.lit(c).alias("c"), x.cast("double").alias("v_num"), F.lit(None).cast("string").alias("v_txt")), lambda c, x: F.struct(F.lit(c).alias("c"), F.lit(None).cast("double").alias("v_num"), x.alias("v_txt"))
    key = F.col("p_partkey")
    cells = F.array(num(1, key), num(2, F.when(key % 5 != 0, F.col("p_size"))), txt(3, F.when(key % 7 != 0, F.col("p_type"))))
    return p.select(F.lit("etc").alias("src"), F.col("p_brand").alias("sheet"), "r", F.inline(cells)).filter("v_num is not null or v_txt is not null")


def _grid_questions(spark, d):
    k, size, kind = F.col("p_partkey"), F.col("p_size").cast("string"), F.col("p_type")
    s = F.get(F.array(F.concat(F.lit("<>"), size), size, F.concat(F.lit(">"), size), F.lit("<>")), (k % 4).cast("int"))
    # "<>" is not blank: parts without a size don't meet it.
    return t(spark, d, "part").select(k.alias("qid"), F.lit("etc").alias("src"), F.col("p_brand").alias("sheet"), F.lit(1).alias("v"), F.lit(2).alias("c1"), s.alias("k1"), F.lit(3).alias("c2"), F.get(F.array(F.lower(kind), F.concat(F.lit("<>"), kind), F.lit("=")), (k % 3).cast("int")).alias("k2"))


@query(f"WITH {GRID_QUESTIONS} SELECT qid, coalesce(cast(sum(p.p_partkey) AS DOUBLE), 0) AS value FROM {GRID_PICK} GROUP BY qid")
def criteria_bulk_grid(spark, d):
    return bulk.on_grid(_brand_sheets(spark, d), _grid_questions(spark, d), [("c1", "k1"), ("c2", "k2")], "v").select("qid", F.coalesce("value", F.lit(0.0)).alias("value"))


@query(f"WITH {GRID_QUESTIONS} SELECT qid, count(p.p_partkey) AS value FROM {GRID_PICK} GROUP BY qid")
def criteria_bulk_page(spark, d):
    """The same rows as aligned columns of a page, sizes as text."""
    p = t(spark, d, "part")
    size, kind = F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("string")), F.when(F.col("p_partkey") % 7 != 0, F.col("p_type"))
    none = F.lit(None).cast("double")
    rows = p.select("p_brand", size.alias("size"), kind.alias("kind"))
    fields = {"k1": bulk.Field("page", none, F.col("size")), "k2": bulk.Field("page", none, F.col("kind"))}
    return bulk.answer(rows, _grid_questions(spark, d), fields, F.lit(1), "count", {"p_brand": "sheet"})


@query("""WITH q AS (SELECT p_partkey AS qid, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'r' END AS flag, p_size * 0.5 AS low, p_size * 0.5 + p_partkey % 30 AS high, p_retailprice * 10 AS most FROM part)
SELECT qid, coalesce(cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS value FROM q LEFT JOIN lineitem ON lower(l_returnflag) = flag AND l_quantity >= low AND l_quantity < high AND l_extendedprice <= most GROUP BY qid""")
def bounds_two_columns(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    q = t(spark, d, "part").select(k.alias("qid"), F.when(k % 2 == 0, "a").otherwise("r").alias("flag"), (size * 0.5).alias("low"), (size * 0.5 + k % 30).alias("high"), (F.col("p_retailprice") * 10).alias("most"))
    got = bulk.compared(t(spark, d, "lineitem"), q, {"l_returnflag": "flag"}, {"l_quantity": [(">=", "low"), ("<", "high")], "l_extendedprice": [("<=", "most")]}, money("l_extendedprice"))
    return got.select("qid", F.col("value").cast("double").alias("value"))


@query("SELECT c_custkey AS qid, count(o_orderkey) AS value FROM customer LEFT JOIN orders ON o_totalprice > c_acctbal * 20 AND o_totalprice <= c_acctbal * 30 GROUP BY 1")
def bounds_without_equal(spark, d):
    q = t(spark, d, "customer").select(F.col("c_custkey").alias("qid"), (F.col("c_acctbal") * 20).alias("low"), (F.col("c_acctbal") * 30).alias("high"))
    return bulk.compared(t(spark, d, "orders"), q, {}, {"o_totalprice": [(">", "low"), ("<=", "high")]}, F.lit(1), "count")


# ------------------------------------------------------------------- long lines
@query("SELECT l_orderkey, l_linenumber, l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC) AS rank FROM lineitem")
def rank_whole_table(spark, d):
    return scans.ranked(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", [])


@query("SELECT o_orderkey, cast(sum(cast(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS upto, count(*) OVER w AS nth FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey ROWS UNBOUNDED PRECEDING)")
def running_totals_long(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    got = scans.running(o, ["o_orderstatus"], [(F.col("o_totalprice"), True), (F.col("o_orderkey"), False)], {"upto": money("o_totalprice"), "nth": F.lit(1)})
    return got.select("o_orderkey", F.col("upto").cast("double").alias("upto"), "nth")


# ------------------------------------------------------------ ranges and lookups
SHEET = "s AS (SELECT l_returnflag AS sheet, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r, l_quantity AS q, l_suppkey AS k, l_linestatus AS s FROM lineitem)"
RANGES = "x AS (SELECT o_orderkey AS qid, CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE 'none' END AS sheet, o_custkey + 1 AS r1, o_custkey + 1 + o_orderkey % 3000 AS r2, o_orderkey % 3 + 1 AS c1, o_orderkey % 5 AS c2 FROM orders)"


def _line_sheets(spark, d):
    """A sheet per return flag: quantities, suppliers as numbers and the line's status as text."""
    order = [(F.col(c), False) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    num = lambda c, x: F.struct(F.lit(c).alias("c"), x.cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))
    txt = F.struct(F.lit(3).alias("c"), F.lit(None).cast("double").alias("num"), F.col("l_linestatus").alias("txt"))
    lines = t(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_linestatus")
    rows = scans.running(lines, ["l_returnflag"], order, {"r": F.lit(1)})  # three sheets: no task holds a whole one
    return rows.select(F.lit("p").alias("part"), F.col("l_returnflag").alias("sheet"), "r", F.inline(F.array(num(1, F.col("l_quantity")), num(2, F.col("l_suppkey")), txt)))


@query(f"""WITH {SHEET}, {RANGES}, p AS (SELECT sheet, r, sum(q) OVER w AS q, sum(k) OVER w AS k, count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY sheet ORDER BY r)),
m AS (SELECT sheet, max(r) AS m FROM s GROUP BY sheet),
b AS (SELECT x.*, least(r2, m) AS hi, least(r1 - 1, m) AS lo FROM x LEFT JOIN m USING (sheet))
SELECT qid, cast(coalesce(CASE WHEN c1 <= 1 AND c2 >= 1 THEN h.q - coalesce(l.q, 0) END, 0) + coalesce(CASE WHEN c1 <= 2 AND c2 >= 2 THEN h.k - coalesce(l.k, 0) END, 0) AS DOUBLE) AS total,
CAST(coalesce((h.n - coalesce(l.n, 0)) * greatest(least(c2, 3) - c1 + 1, 0), 0) AS BIGINT) AS filled
FROM b LEFT JOIN p h ON h.sheet = b.sheet AND h.r = hi LEFT JOIN p l ON l.sheet = b.sheet AND l.r = lo""")
def ranges_many(spark, d):
    """A range per order, long and overlapping, over sheets of a third of lineitem each."""
    k = F.col("o_orderkey")
    r = t(spark, d, "orders").select(k.alias("qid"), F.lit("p").alias("part"), F.get(F.array(*map(F.lit, ("A", "N", "R", "none"))), (k % 4).cast("int")).alias("sheet"), (F.col("o_custkey") + 1).alias("r1"), (k % 3 + 1).alias("c1"), (F.col("o_custkey") + 1 + k % 3000).alias("r2"), (k % 5).alias("c2"))
    return ranges.range_aggregates(r, _line_sheets(spark, d)).select("qid", "total", "filled")


@query(f"""WITH {SHEET}, {RANGES.replace('o_orderkey % 3000', 'o_orderkey % 40')}, n AS (SELECT qid, x.sheet, qid % 50 + 1 AS needle, min(s.r) AS r FROM x LEFT JOIN s ON s.sheet = x.sheet AND s.r BETWEEN r1 AND r2 AND s.q = qid % 50 + 1 GROUP BY ALL)
SELECT qid, CAST(s.k AS DOUBLE) AS num FROM n LEFT JOIN s ON s.sheet = n.sheet AND s.r = n.r""")
def lookups_many_ranges(spark, d):
    """A lookup per order in a column that has 50 values alone."""
    k = F.col("o_orderkey")
    n = t(spark, d, "orders").select(k.alias("qid"), F.lit("p").alias("part"), F.get(F.array(*map(F.lit, ("A", "N", "R", "none"))), (k % 4).cast("int")).alias("sheet"), (F.col("o_custkey") + 1).alias("r1"), F.lit(1).alias("c1"), (F.col("o_custkey") + 1 + k % 40).alias("r2"), F.lit(2).alias("c2"), F.lit(2).alias("index"), (k % 50 + 1).cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))
    return lookups.page_lookup(n, _line_sheets(spark, d), "r").select("qid", "num")


# -------------------------------------------------------------- damaged lines, stores
def _lines(spark, d):
    """Customers as lines of a grid; some are cut off, some are no objects or name no place, balances may be truth values."""
    k = F.col("c_custkey")
    v = F.when(k % 3 == 0, F.col("c_acctbal").cast("decimal(18,2)").cast("string")).when(k % 3 == 1, F.when(F.col("c_acctbal") > 0, "true").otherwise("false")).otherwise(F.to_json(F.struct(F.col("c_mktsegment").alias("s"))).substr(6, 100))
    v = F.when(k % 3 == 2, F.expr("substr(to_json(struct(c_mktsegment AS s)), 6, length(to_json(struct(c_mktsegment AS s))) - 6)")).otherwise(v)
    whole = F.concat(F.lit('{"r":'), k, F.lit(',"c":'), F.col("c_nationkey") + 1, F.lit(',"v":'), v, F.lit("}"))
    line = F.when(k % 50 == 7, F.substring(whole, 1, 12)).when(k % 50 == 8, F.lit("[1]")).when(k % 50 == 9, F.concat(F.lit('{"r":'), k, F.lit("}"))).otherwise(whole)
    return scratch.text_lines(t(spark, d, "customer").select(line.alias("value")), "customers")


@query("SELECT CASE c_custkey % 50 WHEN 7 THEN 'no JSON' WHEN 8 THEN 'no object' ELSE 'no place' END AS reason, count(*) AS n FROM customer WHERE c_custkey % 50 IN (7, 8, 9) GROUP BY 1")
def damaged_lines_set_aside(spark, d):
    return tables.damaged_lines(spark, _lines(spark, d), "grid").groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT CAST(c_custkey AS INTEGER) AS r, c_nationkey + 1 AS c, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS v_num, CASE c_custkey % 3 WHEN 1 THEN CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END WHEN 2 THEN c_mktsegment END AS v_txt FROM customer WHERE c_custkey % 50 NOT IN (7, 8, 9)")
def loaded_grid_kinds(spark, d):
    """Numbers are numbers, truth values and texts are texts; damaged lines are left to damaged_lines()."""
    return tables.load_grid(spark, _lines(spark, d), "etc", skip_damaged=True).select("r", "c", "v_num", "v_txt")


@query("SELECT o_orderpriority AS kind, count(*) AS n, 'orders' AS version FROM orders GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*), 'customer' FROM customer GROUP BY 1")
def published_store(spark, d):
    """Two versions of a store: the second replaces one table and keeps the other."""
    root = scratch.shared_path(spark, "store")
    count = lambda name, column: t(spark, d, name).groupBy(F.col(column).alias("kind")).agg(F.count("*").alias("n"))
    store.publish(spark, root, {"a": count("orders", "o_orderpriority"), "b": count("orders", "o_orderstatus")})
    store.publish(spark, root, {"b": count("customer", "c_mktsegment")})
    return store.table(spark, root, "a").withColumn("version", F.lit("orders")).union(store.table(spark, root, "b").withColumn("version", F.lit("customer")))


# ------------------------------------------------------------------------ scalars
EXTREME = (0.0, 3.0, 1e10, -1e10, 1e308, -1e308)


@query(f"""WITH x AS (SELECT p_partkey, p_name, CASE p_partkey % {len(EXTREME)} {' '.join(f'WHEN {i} THEN {x!r}' for i, x in enumerate(EXTREME))} END::DOUBLE AS n FROM part)
SELECT p_partkey, CASE WHEN n >= 0 THEN left(p_name, least(n, length(p_name))::INTEGER) END AS l, CASE WHEN n > 0 THEN right(p_name, least(n, length(p_name))::INTEGER) WHEN n = 0 THEN '' END AS r,
CASE WHEN n >= 0 THEN CASE WHEN n = 0 THEN round(p_partkey / 4) ELSE p_partkey / 4 END ELSE 0 END AS rounded, CASE n WHEN 0 THEN format('{{:.0f}}', round(p_partkey / 4)) WHEN 3 THEN format('{{:.3f}}', p_partkey / 4) WHEN -1e10 THEN '0' WHEN -1e308 THEN '0' END AS shown FROM x""")
def scalars_extreme(spark, d):
    k = F.col("p_partkey")
    p = t(spark, d, "part").select(k, "p_name", F.get(F.array(*map(F.lit, EXTREME)), (k % len(EXTREME)).cast("int")).alias("n"))
    n, x = F.col("n"), k / 4
    return p.select(k, sc.left(F.col("p_name"), n).alias("l"), sc.right(F.col("p_name"), n).alias("r"), sc.round_half_away(x, n).alias("rounded"), sc.text_fixed(x, n).alias("shown"))


# ------------------------------------------------------------------- verification
@query("""WITH v AS (SELECT 'p' || n_regionkey AS part, CASE WHEN n_nationkey % 4 = 0 THEN 'mismatch' ELSE 'match' END AS verdict FROM nation)
SELECT CASE WHEN grouping(part) = 0 AND grouping(verdict) = 0 THEN 'part and verdict' WHEN grouping(part) = 0 THEN 'part' WHEN grouping(verdict) = 0 THEN 'verdict' ELSE 'overall' END AS level, part, verdict, count(*) AS n FROM v GROUP BY CUBE (part, verdict)""")
def verify_totals(spark, d):
    v = t(spark, d, "nation").select(F.concat(F.lit("p"), "n_regionkey").alias("part"), F.when(F.col("n_nationkey") % 4 == 0, "mismatch").otherwise("match").alias("verdict"))
    return verification.totals(v)


# ------------------------------------------------------------------- moved anchors
@query("""WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 50 = 3 AND c_nationkey % 4 = 1 THEN 1000.0 ELSE round(c_acctbal) END AS v, c_custkey % 50 = 3 AND c_nationkey % 4 = 1 AS moved FROM customer),
n AS (SELECT c_nationkey, sum(v) AS v, bool_or(moved) AS moved FROM c GROUP BY 1),
r AS (SELECT n_regionkey, sum(coalesce(v, 0)) AS v, coalesce(bool_or(moved), false) AS moved FROM nation LEFT JOIN n ON c_nationkey = n_nationkey GROUP BY 1)
SELECT 'c' || c_custkey AS cell, v AS num, moved AS touched FROM c UNION ALL SELECT 'n' || c_nationkey, v, moved FROM n UNION ALL SELECT 'r' || n_regionkey, v, moved FROM r UNION ALL SELECT 'all', sum(v), bool_or(moved) FROM r""")
def moved_inputs(spark, d):
    """Balances add up by nation, region and overall; some balances change, and only what rests on them is evaluated again."""
    c = t(spark, d, "customer").filter("c_nationkey is not null")
    n = t(spark, d, "nation")
    name = lambda p, k: F.concat(F.lit(p), k)
    inputs = c.select(name("c", "c_custkey").alias("cell"), F.round("c_acctbal").alias("num"))
    by_nation = c.select(name("n", "c_nationkey").alias("cell"), F.col("c_custkey").cast("int").alias("pos"), name("c", "c_custkey").alias("needs"))
    by_region = n.select(name("r", "n_regionkey").alias("cell"), F.col("n_nationkey").alias("pos"), name("n", "n_nationkey").alias("needs"))
    overall = n.select(F.lit("all").alias("cell"), F.col("n_regionkey").alias("pos"), name("r", "n_regionkey").alias("needs")).distinct()
    edges = by_nation.union(by_region).union(overall)
    specs = edges.select("cell").distinct().withColumn("shape", F.lit("sum"))
    before = scratch.written(levels.evaluate(inputs, specs, edges), "values")
    changed = c.filter("c_custkey % 50 = 3 and c_nationkey % 4 = 1").select(name("c", "c_custkey").alias("cell"), F.lit(1000.0).alias("num"))
    return levels.reevaluate(before, changed, specs, edges).select("cell", "num", "touched")


@query("""WITH RECURSIVE n AS (SELECT n_nationkey AS k, n_regionkey AS g, lead(n_nationkey) OVER w AS nxt, first_value(n_nationkey) OVER w AS head FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)),
e AS (SELECT k AS cell, coalesce(nxt, CASE WHEN g <> 0 THEN head END) AS needs FROM n UNION ALL SELECT head, (SELECT min(k) FROM n m WHERE m.g = n.g + 1) FROM n WHERE g IN (1, 2) AND k = head
UNION ALL SELECT 1000 + s_suppkey, s_nationkey FROM supplier),
r AS (SELECT cell, needs FROM e WHERE needs IS NOT NULL UNION SELECT r.cell, e.needs FROM r JOIN e ON e.cell = r.needs WHERE e.needs IS NOT NULL),
o AS (SELECT a.cell, min(a.needs) AS component FROM r a JOIN r b ON a.needs = b.cell AND b.needs = a.cell GROUP BY 1)
SELECT DISTINCT r.cell::BIGINT AS cell, o.component::BIGINT AS component FROM r LEFT JOIN o USING (cell) WHERE o.component IS NOT NULL OR r.needs IN (SELECT cell FROM o)""")
def cycle_components(spark, d):
    """Nations need the next one of their region, in rings but for region 0; two rings need another; suppliers need their nation."""
    w = scans.W.partitionBy("n_regionkey").orderBy("n_nationkey")
    n = t(spark, d, "nation").select("n_nationkey", "n_regionkey", F.lead("n_nationkey").over(w).alias("next"), F.first("n_nationkey").over(w).alias("head"))
    ring = n.select(F.col("n_nationkey").alias("cell"), F.coalesce("next", F.when(F.col("n_regionkey") != 0, F.col("head"))).alias("needs"))
    heads = n.filter("n_nationkey = head")
    across = heads.filter("n_regionkey in (1, 2)").join(heads.select((F.col("n_regionkey") - 1).alias("n_regionkey"), F.col("head").alias("needs")), "n_regionkey").select(F.col("head").alias("cell"), "needs")
    behind = t(spark, d, "supplier").select((F.col("s_suppkey") + 1000).alias("cell"), F.col("s_nationkey").alias("needs"))
    edges = ring.union(across).union(behind).filter("needs is not null").select(F.col("cell").cast("long").alias("cell"), F.col("needs").cast("long").alias("needs"))
    return levels.cycles(edges.select("cell").union(edges.select("needs")), edges)
