"""Verdicts on computed cells: comparison with published values, exemptions, summaries, floors and snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import cell, same_value
from ..sources.store import publish
from .aggregates import small

AT = ["part", "sheet", "ref"]
COMPARABLE = ("match", "mismatch", "error", "known-divergence")
FAILURES = ("mismatch", "error", "unsupported", "no-oracle")


def verdicts(specs: DataFrame, oracle: DataFrame, computed: DataFrame) -> DataFrame:
    """specs(part, sheet, ref, kind) with expected and got cells and a verdict; sheets named _... are helpers and left out.

    oracle and computed hold num and txt, computed also err for cells whose evaluation failed.
    """
    e = oracle.select(*AT, F.col("num").alias("e_num"), F.col("txt").alias("e_txt"), F.lit(True).alias("known"))
    g = computed.select(*AT, F.col("num").alias("g_num"), F.col("txt").alias("g_txt"), "err")
    both = specs.filter(~F.col("sheet").startswith("_")).join(e, AT, "left").join(g, AT, "left")
    expected, got = cell(F.col("e_num"), F.col("e_txt")), cell(F.col("g_num"), F.col("g_txt"))
    verdict = F.when(F.col("known").isNull(), "no-oracle").when(F.col("kind") != "expr", F.col("kind")).when(F.col("err").isNotNull(), "error").when(same_value(expected, got), "match").otherwise("mismatch")
    return both.select(*AT, verdict.alias("verdict"), "e_num", "e_txt", "g_num", "g_txt")


def _pair(df: DataFrame, num: str, txt: str) -> Column:
    """A cell value from two columns; a table may lack the one for texts."""
    return cell(df[num], df[txt] if txt in df.columns else None)


def exempt(results: DataFrame, exemptions: DataFrame) -> DataFrame:
    """Mismatches become known divergences where published and computed value are those that were pinned.

    exemptions(part, sheet, ref, e_num, g_num, optionally e_txt and g_txt): of several
    for a cell, one that holds is enough.
    """
    x = exemptions.select(*AT, _pair(exemptions, "e_num", "e_txt").alias("x_e"), _pair(exemptions, "g_num", "g_txt").alias("x_g"))
    both = results.filter("verdict = 'mismatch'").join(small(x), AT)
    held = both.filter(same_value(F.col("x_e"), _pair(both, "e_num", "e_txt")) & same_value(F.col("x_g"), _pair(both, "g_num", "g_txt")))
    held = held.select(*AT, F.lit(True).alias("held")).distinct()
    out = results.join(held, AT, "left")
    return out.withColumn("verdict", F.when((F.col("verdict") == "mismatch") & F.col("held"), "known-divergence").otherwise(F.col("verdict"))).drop("held")


def stale(exemptions: DataFrame, results: DataFrame) -> DataFrame:
    """Exemptions that no longer apply, and why."""
    r = results.select(*AT, "verdict", _pair(results, "e_num", "e_txt").alias("now_e"), _pair(results, "g_num", "g_txt").alias("now_g"))
    x = exemptions.select(*AT, _pair(exemptions, "e_num", "e_txt").alias("x_e"), _pair(exemptions, "g_num", "g_txt").alias("x_g"))
    why = (
        F.when(F.col("verdict").isNull(), "the cell is gone")
        .when(F.col("verdict") == "match", "it matches now")
        .when(~same_value(F.col("x_e"), F.col("now_e")), "the published value has changed")
        .when(~same_value(F.col("x_g"), F.col("now_g")), "the computed value has changed")
        .when(~F.col("verdict").isin("mismatch", "known-divergence"), "it is no mismatch now")
    )
    return x.join(r, AT, "left").select(*AT, why.alias("reason")).filter("reason is not null")


def write_report(results: DataFrame, path: str, reason: str | None = None) -> None:
    """Publish in the store at path: summary (counts at all levels), detail (all cells that do not match) and, with a column of reasons, reasons (how often each occurs), as JSON lines."""
    out = {"summary": totals(results), "detail": results.filter("verdict <> 'match'")}
    if reason:
        out["reasons"] = reason_groups(results.filter(F.col(reason).isNotNull()), reason, "ref")
    publish(results.sparkSession, path, out, "json")


def summary(results: DataFrame) -> DataFrame:
    """Counts by part and verdict."""
    return results.groupBy("part", "verdict").agg(F.count("*").alias("n"))


def totals(results: DataFrame) -> DataFrame:
    """part, verdict, n at all levels in one pass: by both, by part (verdict null), by verdict (part null) and overall; level says which."""
    level = F.element_at(F.array(*map(F.lit, ("part and verdict", "part", "verdict", "overall"))), (F.grouping_id() + 1).cast("int"))
    return results.groupingSets([["part", "verdict"], ["part"], ["verdict"], []], "part", "verdict").agg(level.alias("level"), F.count("*").alias("n")).select("level", "part", "verdict", "n")


def rates(results: DataFrame) -> DataFrame:
    """part, comparable, matches, rate (percent, over comparable cells), passed, failures."""
    is_ = lambda *v: F.count(F.when(F.col("verdict").isin(*v), 1))
    out = results.groupBy("part").agg(is_(*COMPARABLE).alias("comparable"), is_("match").alias("matches"), is_(*FAILURES).alias("failures"))
    return out.select("part", "comparable", "matches", F.try_divide(F.col("matches") * 100.0, "comparable").alias("rate"), (F.col("failures") == 0).alias("passed"), "failures")


@dataclass(frozen=True)
class Floor:
    """What a run must at least cover."""

    parts: int
    cells: int


def floor_violations(by_part: DataFrame, floor: Floor | None) -> list[str]:
    """by_part: rates(). Nothing missing: an empty list. Without a floor nothing passes."""
    if floor is None:
        return ["there is no snapshot to compare with"]
    got = by_part.agg(F.count("*").alias("parts"), F.coalesce(F.sum("comparable"), F.lit(0)).alias("cells")).first()
    return [f"{k}: {got[k]}, at least {getattr(floor, k)} expected" for k in ("parts", "cells") if got[k] < getattr(floor, k)]


def raised(old: Floor | None, new: Floor) -> Floor:
    """A snapshot's new floor; it never falls."""
    if old and (new.parts < old.parts or new.cells < old.cells):
        raise ValueError("the new snapshot covers less than the old one")
    return new


def write_snapshot(results: DataFrame, path: str, old: Floor | None) -> Floor:
    """Publish the compared cells' values and the counts as JSON lines in the store at path, both or neither; the new floor. Refused if a cell fails or less is covered than before."""
    by_part = rates(results)
    got = by_part.agg(F.count("*").alias("parts"), F.coalesce(F.sum("comparable"), F.lit(0)).alias("cells"), F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")).first()
    if got["failures"]:
        raise ValueError(f"{got['failures']} cells fail")
    new = raised(old, Floor(got["parts"], got["cells"]))
    compared = results.filter(F.col("verdict").isin(*COMPARABLE))
    values = compared.select(F.concat_ws("!", *AT).alias("key"), F.col("g_num").alias("num"), F.col("g_txt").alias("txt"))
    publish(results.sparkSession, path, {"values": values, "counts": totals(results)}, "json")
    return new


def reason_key(reason: Column) -> Column:
    """Reasons without what differs from cell to cell: brackets at the end, what follows a colon if it has digits, blanks, quotes or brackets, and numbers."""
    key = F.regexp_replace(reason, r"\s*\([^()]*\)\s*$", "")
    colon = r"(?s)^(.*?):\s(.+)$"
    noisy = F.regexp_extract(key, colon, 2).rlike(r"""[\d\s"'\[\]{}]""")
    return F.trim(F.regexp_replace(F.when(noisy, F.regexp_extract(key, colon, 1)).otherwise(key), r"\d+", "#"))


def reason_groups(rows: DataFrame, reason: str, sample: str) -> DataFrame:
    """key, n, sample (the smallest), the most frequent first."""
    return rows.groupBy(reason_key(F.col(reason)).alias("key")).agg(F.count("*").alias("n"), F.min(sample).alias("sample")).orderBy(F.desc("n"), "key")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, status: missing, extra or changed values(num, txt) between two snapshots."""
    a = old.select(*keys, F.col("num").alias("a_num"), F.col("txt").alias("a_txt"), F.lit(True).alias("in_a"))
    b = new.select(*keys, F.col("num").alias("b_num"), F.col("txt").alias("b_txt"), F.lit(True).alias("in_b"))
    same = same_value(cell(F.col("a_num"), F.col("a_txt")), cell(F.col("b_num"), F.col("b_txt")))
    status = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "extra").when(~same, "changed")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status")).filter("status is not null")
