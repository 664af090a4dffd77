"""From verified cells to published tables and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import floor, number_value, round_half_up
from ..sources.scratch import written

#: Units in which a printed table may show a value.
SCALES = (1.0, 10.0, 100.0, 1000.0, 0.1, 0.01, 0.001)
MOST_HITS = 40


def shown(value: Column, decimals: Column) -> Column:
    """A value as printed with so many decimals."""
    p = F.pow(F.lit(10.0), decimals)
    return floor(value * p + 0.5) / p


def value_hits(printed: DataFrame, cells: DataFrame, scales: tuple[float, ...] = SCALES) -> DataFrame:
    """table, i, j, sheet, scale, r, c, hits: the places whose value, in some unit, is shown as a printed cell.

    printed(table, i, j, value, decimals); cells(sheet, r, c, num). A value with
    more than MOST_HITS places in a sheet says nothing. An equi join on rounded values.
    """
    places = cells.filter(F.col("num").isNotNull()).select("sheet", "r", "c", "num", F.explode(F.array(*(F.lit(s) for s in scales))).alias("scale"))
    places = places.select("sheet", "r", "c", "scale", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("decimals"), "num")
    places = places.withColumn("shown", shown(F.col("num") * F.col("scale"), F.col("decimals"))).drop("num")
    # Values that are everywhere go before the join.
    often = places.groupBy("sheet", "scale", "decimals", "shown").agg(F.count("*").alias("hits")).filter(F.col("hits") <= MOST_HITS)
    places = places.join(often, ["sheet", "scale", "decimals", "shown"])
    asked = printed.filter(F.col("value").isNotNull()).select("table", "i", "j", "decimals", F.col("value").alias("shown"))
    return asked.join(places, ["decimals", "shown"]).select("table", "i", "j", "sheet", "scale", "r", "c", "hits")


def line_votes(hits: DataFrame, line: str, to: str) -> DataFrame:
    """table, sheet, scale, line, to, votes: each printed cell shares a vote among the places that show it."""
    return hits.groupBy("table", "sheet", "scale", line, to).agg(F.sum(F.lit(1.0) / F.col("hits")).alias("votes"))


def value_votes(printed: DataFrame, cells: DataFrame, scales: tuple[float, ...] = SCALES) -> DataFrame:
    """table, sheet, scale, i, r, votes: how strongly printed row i of a table speaks for row r of a sheet."""
    return line_votes(value_hits(printed, cells, scales), "i", "r")


def best_sheet(votes: DataFrame) -> DataFrame:
    """table, sheet, scale, votes: the sheet and scale with the most votes, each printed row voting for its best row; ties by name, then scale."""
    rows = votes.groupBy("table", "sheet", "scale", "i").agg(F.max("votes").alias("votes"))
    score = rows.groupBy("table", "sheet", "scale").agg(F.sum("votes").alias("votes"))
    w = W.partitionBy("table").orderBy(F.desc(F.round("votes", 9)), "sheet", "scale")
    return score.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def acceptance(rate: Column, matched: Column) -> Column:
    """How far an alignment can be trusted, by the share and the number of printed values that it reproduces."""
    return F.when((rate >= 0.9) & (matched >= 4), "ok").when((rate >= 0.7) & (matched >= 3), "weak").otherwise("fail")


def greedy_pairs(votes: DataFrame, line: str = "i", to: str = "r") -> DataFrame:
    """table, sheet, scale, line, to, votes: each printed line, the one with the strongest vote first, takes its strongest line of the sheet that is free.

    Votes are compared to nine decimals; of equal ones the lower line comes first.
    One array per printed table, sheet and unit: its size is that of a table on a page.
    """
    keys, kinds = ["table", "sheet", "scale"], dict(votes.dtypes)
    weighed = votes.withColumn("w", -F.round("votes", 9))
    lines = weighed.groupBy(*keys, line).agg(F.min("w").alias("best"), F.array_sort(F.collect_list(F.struct("w", F.col(to).alias("to"), "votes"))).alias("offers"))
    tables = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("best", F.col(line).alias("line"), "offers"))).alias("lines"))
    start = F.struct(F.array().cast(f"array<{kinds[to]}>").alias("used"), F.array().cast(f"array<struct<line:{kinds[line]},to:{kinds[to]},votes:double>>").alias("got"))

    def take(state: Column, x: Column) -> Column:
        free = F.get(F.filter(x["offers"], lambda o: ~F.array_contains(state["used"], o["to"])), F.lit(0))
        pair = F.struct(x["line"].alias("line"), free["to"].alias("to"), free["votes"].alias("votes"))
        keep = lambda name, one: F.when(free.isNull(), state[name]).otherwise(F.concat(state[name], F.array(one))).alias(name)
        return F.struct(keep("used", free["to"]), keep("got", pair))

    got = tables.select(*keys, F.inline(F.aggregate("lines", start, take)["got"]))
    return got.withColumnsRenamed({"line": line, "to": to})


def align(printed: DataFrame, cells: DataFrame, scales: tuple[float, ...] = SCALES) -> DataFrame:
    """table, sheet, scale, rate, pairs, matched, score, status, rows(i, r), cols(j, c): each printed table laid over each sheet by its values alone.

    Printed rows and columns vote for those of the sheet and are assigned greedily.
    Then every printed number whose row and column are assigned is compared with the
    cell there (pairs; a missing cell counts against it). The unit with the best
    score wins: the rate in percent, the number of matches, and half a point each
    for rows and columns in ascending order; of equals the first of `scales`.
    """
    keys = ["table", "sheet", "scale"]
    hits = written(value_hits(printed, cells, scales), "hits")
    lines = written(greedy_pairs(line_votes(hits, "i", "r")), "rows")
    columns = written(greedy_pairs(line_votes(hits, "j", "c"), "j", "c"), "columns")
    asked = printed.filter(F.col("value").isNotNull()).select("table", "i", "j", "value", "decimals")
    at = lines.select(*keys, "i", "r").join(columns.select(*keys, "j", "c"), keys).join(asked, ["table", "i", "j"])
    at = at.join(cells.select("sheet", "r", "c", "num"), ["sheet", "r", "c"], "left")
    same = shown(F.col("num") * F.col("scale"), F.col("decimals")) == shown(F.col("value"), F.col("decimals"))
    checked = at.groupBy(*keys).agg(F.count("*").alias("pairs"), F.count_if(same).alias("matched"))
    listed = lambda df, a, b, name: df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(a, b))).alias(name))
    both = checked.join(listed(lines, "i", "r", "rows"), keys).join(listed(columns, "j", "c", "cols"), keys)

    def rising(name: str, to: str) -> Column:
        order = F.transform(name, lambda x: x[to])
        return F.when(order == F.array_sort(order), 0.5).otherwise(0.0)

    rate = F.col("matched") / F.col("pairs")
    scored = both.withColumns({"rate": F.round(rate, 3), "score": rate * 100 + F.col("matched") + rising("rows", "r") + rising("cols", "c")})
    place = F.array_position(F.array(*(F.lit(s) for s in scales)), F.col("scale"))
    w = W.partitionBy("table", "sheet").orderBy(F.desc("score"), place)
    best = scored.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return best.select(*keys, "rate", "pairs", "matched", "score", acceptance(F.col("rate"), F.col("matched")).alias("status"), "rows", "cols")


def table_spec(aligned: DataFrame, texts: DataFrame, corner: str = "") -> DataFrame:
    """aligned(table, sheet, scale, rate, pairs, matched, status, rows, cols) with what a table on a page shows beside its values.

    texts(table, i, j, text): all printed cells. head: the distinct texts above
    the first row with values, by column; labels: the texts left of the first column
    with values, by row; corner: where both meet; decimals: the usual number of
    each column, of equally frequent ones the smallest. Tables that fail are left out.
    """
    keys = ["table", "sheet"]
    good = aligned.filter("status <> 'fail'")
    edges = good.select(*keys, F.array_min(F.transform("rows", lambda x: x["i"])).alias("top"), F.array_min(F.transform("cols", lambda x: x["j"])).alias("left"), "rows", "cols")
    text = F.trim("text")
    cols = edges.select(*keys, "top", F.posexplode("cols").alias("at", "x")).select(*keys, "top", "at", F.col("x.j").alias("j")).join(texts, ["table", "j"], "left")
    heads = cols.filter(F.col("i").isNull() | (F.col("i") < F.col("top"))).groupBy(*keys, "at").agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(text != "", F.struct("i", text.alias("text"))))), lambda x: x["text"])), " ").alias("head"))
    rows = edges.select(*keys, "left", F.posexplode("rows").alias("at", "x")).select(*keys, "left", "at", F.col("x.i").alias("i"))
    beside = rows.join(texts, ["table", "i"], "left")
    labels = beside.groupBy(*keys, "at").agg(F.coalesce(F.max(F.when(F.col("j") == F.greatest(F.col("left") - 1, F.lit(0)), text)), F.lit("")).alias("label"))
    shown_at = cols.join(rows.select(*keys, "i"), [*keys, "i"]).filter(number_value(F.col("text")).isNotNull()).groupBy(*keys, "at", decimals_of(F.col("text")).alias("d")).agg(F.count("*").alias("n"))
    usual = shown_at.groupBy(*keys, "at").agg(F.min_by("d", F.struct(-F.col("n"), "d")).alias("d"))
    corners = edges.join(texts, "table").filter((F.col("i") == F.greatest(F.col("top") - 1, F.lit(0))) & (F.col("j") == F.greatest(F.col("left") - 1, F.lit(0)))).select(*keys, F.nullif(text, F.lit("")).alias("corner"))
    by_col = cols.select(*keys, "at").distinct().join(heads, [*keys, "at"], "left").join(usual, [*keys, "at"], "left")
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("at", c.alias("v")))), lambda x: x["v"])
    by_col = by_col.groupBy(*keys).agg(listed(F.coalesce("head", F.lit(""))).alias("head"), listed(F.coalesce("d", F.lit(0))).alias("decimals"))
    by_row = labels.groupBy(*keys).agg(listed(F.col("label")).alias("labels"))
    out = good.join(by_col, keys).join(by_row, keys).join(corners, keys, "left")
    return out.select(*keys, "scale", "rate", "pairs", "matched", "status", "head", "labels", F.transform("rows", lambda x: x["r"]).alias("rows"), F.transform("cols", lambda x: x["c"]).alias("cols"), "decimals", F.coalesce("corner", F.lit(corner)).alias("corner"))


def project_table(spec: DataFrame, cells: DataFrame, published: DataFrame) -> DataFrame:
    """page, i, j, value, source: a table's cells by spec(page, part, sheet, rows, cols, scale, decimals); computed ones first, then published."""
    at = spec.select("page", "part", "sheet", "scale", "decimals", F.posexplode("rows").alias("i", "r"), "cols")
    at = at.select("page", "part", "sheet", "scale", F.col("i"), "r", F.posexplode("cols").alias("j", "c"), "decimals").withColumn("d", F.element_at("decimals", F.col("j") + 1))
    keys = ["part", "sheet", "r", "c"]
    out = at.join(cells.select(*keys, F.col("num").alias("own")), keys, "left").join(published.select(*keys, F.col("num").alias("printed")), keys, "left")
    value = F.coalesce("own", "printed") * F.col("scale")
    p = F.pow(F.lit(10.0), F.col("d"))
    return out.select("page", "i", "j", (floor(value * p + 0.5) / p).alias("value"), F.when(F.col("own").isNotNull(), "v").when(F.col("printed").isNotNull(), "x").alias("source"))


def chart_series(series: DataFrame, cells: DataFrame) -> DataFrame:
    """chart, series, values: a chart's series(chart, series, sheet, r, c1, c2) as ordered arrays; blank places are null."""
    places = series.select("chart", "series", "sheet", "r", F.posexplode(F.sequence("c1", "c2")).alias("pos", "c"))
    got = places.join(cells, ["sheet", "r", "c"], "left")
    return got.groupBy("chart", "series").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "num"))), lambda x: x["num"]).alias("values"))


def inherit_categories(series: DataFrame) -> DataFrame:
    """Series without categories take those of the last one before them in their chart."""
    w = W.partitionBy("chart").orderBy("series").rowsBetween(W.unboundedPreceding, 0)
    return series.withColumn("cat", F.last("cat", ignorenulls=True).over(w))


def axis_top(points: DataFrame) -> DataFrame:
    """chart, top: the largest stack of positive values."""
    return points.groupBy("chart", "cat").agg(F.sum(F.greatest("value", F.lit(0.0))).alias("stack")).groupBy("chart").agg(F.max("stack").alias("top"))


def pie_shares(points: DataFrame, label_from: float = 5.0) -> DataFrame:
    """Percent of each positive value in its chart, to one decimal, and whether it is labelled."""
    share = F.col("value") * 100.0 / F.sum("value").over(W.partitionBy("chart"))
    return points.filter("value > 0").withColumn("pct", round_half_up(share, 1)).withColumn("labelled", F.col("pct") >= label_from)


def fullest_categories(series: DataFrame) -> DataFrame:
    """chart, series: the one with the most filled categories, the first of equals."""
    w = W.partitionBy("chart").orderBy(F.desc("filled"), "series")
    return series.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def layout(cells: DataFrame, refs: tuple[str, ...] = ("A1", "A2", "C2")) -> DataFrame:
    """part, sheet and the texts at some places, as columns."""
    return cells.filter(F.col("ref").isin(*refs)).groupBy("part", "sheet").agg(*(F.max(F.when(F.col("ref") == r, F.col("txt"))).alias(r.lower()) for r in refs))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def toc(pages: DataFrame) -> DataFrame:
    """part, chapter, pages: each chapter's pages in order."""
    return pages.groupBy("part", "chapter").agg(F.array_sort(F.collect_list("page")).alias("pages"))


def tree(pages: DataFrame) -> DataFrame:
    """part, chapters(chapter, sections(section, pages)): the contents as a tree, each level in the order of its first page.

    pages(pos, part, chapter, section, page); a page without a section is in the empty one.
    """
    listed = lambda *names: F.transform(F.array_sort(F.collect_list(F.struct("pos", *names))), lambda x: F.struct(*(x[n].alias(n) for n in names)))
    pages = pages.withColumn("section", F.coalesce("section", F.lit("")))
    sections = pages.groupBy("part", "chapter", "section").agg(F.min("pos").alias("first"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "page"))), lambda x: x["page"]).alias("pages")).withColumnRenamed("first", "pos")
    chapters = sections.groupBy("part", "chapter").agg(F.min("pos").alias("first"), listed("section", "pages").alias("sections")).withColumnRenamed("first", "pos")
    return chapters.groupBy("part").agg(listed("chapter", "sections").alias("chapters"))


def value_axes(groups: DataFrame, axes: DataFrame) -> DataFrame:
    """groups(chart, grp, ids) with axis: "r" if the last of its axes that shows values stands on the right, else "l"; axes(chart, id, type, pos)."""
    ids = groups.select("chart", "grp", F.posexplode("ids").alias("at", "id")).join(axes.filter("type = 'valAx'"), ["chart", "id"])
    last = ids.groupBy("chart", "grp").agg(F.max_by(F.coalesce("pos", F.lit("l")), "at").alias("pos"))
    return groups.join(last, ["chart", "grp"], "left").withColumn("axis", F.when(F.col("pos") == "r", "r").otherwise("l")).drop("pos")


def data_table(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Tables of rows(table, i, cells array<string>) that look like data: 2 rows, 3 columns, 6 filled cells, 4 in 10 of them numbers."""
    filled = F.filter(cells, lambda x: F.trim(x) != "")
    numbers = F.filter(filled, lambda x: F.regexp_replace(x, ",", "").rlike(r"^\s*-?\d+(\.\d+)?%?\s*$"))
    out = rows.groupBy("table").agg(F.count("*").alias("n_rows"), F.max(F.size(cells)).alias("n_cols"), F.sum(F.size(filled)).alias("filled"), F.sum(F.size(numbers)).alias("numbers"))
    return out.filter((F.col("n_rows") >= 2) & (F.col("n_cols") >= 3) & (F.col("filled") >= 6) & (F.col("numbers") >= 0.4 * F.col("filled")))


def nice_top(x: Column) -> Column:
    """The next of 1, 2, 5 or 10 times a power of ten."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(x)))
    m = x / p
    return F.when(m <= 1, p).when(m <= 2, 2 * p).when(m <= 5, 5 * p).otherwise(10 * p)


def search(pages: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Pages whose columns together hold a text, whatever its case."""
    return pages.filter(F.lower(F.concat_ws(" ", *columns)).contains(text.lower()))


def decimals_of(shown: Column) -> Column:
    """Decimal places of a printed number."""
    return F.length(F.regexp_extract(shown, r"\.(\d+)", 1))


def usual_decimals(shown: DataFrame) -> DataFrame:
    """table, j, decimals: each column's most frequent number of decimals, of equals the one seen first; shown(table, i, j, text)."""
    n = shown.groupBy("table", "j", decimals_of(F.col("text")).alias("decimals")).agg(F.count("*").alias("n"), F.min("i").alias("first"))
    w = W.partitionBy("table", "j").orderBy(F.desc("n"), "first")
    return n.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("table", "j", "decimals")


def prefer(first: DataFrame, second: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """All rows of either; where both have a key, those of the first, as a whole."""
    a = first.select(*keys, *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(True).alias("_a"))
    b = second.select(*keys, *(F.col(c).alias(f"b_{c}") for c in columns))
    return a.join(b, keys, "full_outer").select(*keys, *(F.when(F.col("_a"), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c) for c in columns))


def compact(x: Column) -> Column:
    """A number on a chart: no decimals from 1000, one from 100 if it has any, else two at most."""
    digits = F.when(F.abs(x) >= 1000, 0).when(F.abs(x) >= 100, 1).otherwise(2)
    return F.regexp_replace(F.when(digits == 0, F.format_number(x, 0)).when(digits == 1, F.format_number(x, 1)).otherwise(F.format_number(x, 2)), r"(\.\d*?)0+$", "$1").alias("shown")


def bundle(pages: DataFrame, charts: DataFrame, table_cells: DataFrame) -> DataFrame:
    """page, document: one JSON text per page with its charts' series and its table's cells; pages without either are kept."""
    c = charts.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("chart", "series", "values"))).alias("charts"))
    x = table_cells.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("i", "j", "value", "source"))).alias("cells"))
    out = pages.join(c, "page", "left").join(x, "page", "left")
    return out.select("page", F.to_json(F.struct(*(k for k in out.columns))).alias("document"))


def required_cells(leaves: DataFrame, charted: DataFrame, specs: DataFrame) -> DataFrame:
    """part, sheet, ref: cells whose constants must be kept, each once: leaves of formulas, and cells that charts show and no formula fills."""
    at = ["part", "sheet", "ref"]
    return leaves.select(*at).union(charted.select(*at).join(specs.select(*at), at, "left_anti")).distinct()


def distinct_tables(rows: DataFrame, page: str = "page") -> DataFrame:
    """rows(page, table, i, cells) without the tables whose rows all equal those of an earlier table on their page."""
    whole = rows.groupBy(page, "table").agg(F.to_json(F.array_sort(F.collect_list(F.struct("i", "cells")))).alias("key"))
    first = whole.groupBy(page, "key").agg(F.min("table").alias("table")).drop("key")
    return rows.join(first, [page, "table"], "left_semi")


def legend(entries: DataFrame) -> DataFrame:
    """entries(chart, pos, label, color) with each label and color once, in order, for charts that have two or more of them."""
    once = entries.filter(F.coalesce("label", F.lit("")) != "").groupBy("chart", "label", "color").agg(F.min("pos").alias("pos"))
    return once.withColumn("_n", F.count("*").over(W.partitionBy("chart"))).filter("_n >= 2").drop("_n")


def leaf_kind(num: Column, txt: Column) -> Column:
    """What a constant that formulas rest on seems to be."""
    whole = num == floor(num)
    return F.when(txt.isNotNull(), "label").when(num.isNull(), "other").when(whole & num.between(1960, 2100), "year").when(whole & (F.abs(num) <= 100), "small number").otherwise("value")


def literal_dependencies(leaves: DataFrame, values: DataFrame) -> DataFrame:
    """part, sheet, n_leaves, users, cells(ref, users, kind): the constants on each sheet and how many cells rest on them, the most used first.

    leaves(part, sheet, ref, cell): a leaf and a cell that rests on it; values(part, sheet, ref, num, txt).
    """
    at = ["part", "sheet", "ref"]
    used = leaves.groupBy(*at).agg(F.count_distinct("cell").alias("users")).join(values.select(*at, "num", "txt"), at, "left")
    rows = used.select(*at, "users", leaf_kind(F.col("num"), F.col("txt")).alias("kind"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("users")).alias("less"), "ref", "users", "kind"))), lambda x: F.struct(x["ref"].alias("ref"), x["users"].alias("users"), x["kind"].alias("kind")))
    return rows.groupBy("part", "sheet").agg(F.count("*").alias("n_leaves"), F.sum("users").alias("users"), cells.alias("cells"))
