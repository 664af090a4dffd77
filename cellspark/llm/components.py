"""Connected components of a table of edges, by minimum labels with pointer jumping.

Nothing but counts reaches the driver; each round is a table in the shared
folder. A vertex may have a third of all edges, a label a third of all vertices:
what meets them is dealt out by salt. Edges with a null end are ignored; loops and repeated edges do no harm;
no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SALTS = 16


def components(edges: DataFrame) -> DataFrame:
    """v, label: for each vertex of edges(a, b), the smallest vertex of its component."""
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    e = edges.filter("a is not null and b is not null and a <> b").select("a", "b")
    both = table(e.union(e.select("b", "a")).distinct().toDF("a", "b").withColumn("salt", salt("a")), "edges")
    labels = table(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        # Every vertex takes the smallest label around it, and then that label's own label.
        near = both.join(labels.select(F.col("v").alias("b"), "label", salts.alias("salt")), ["b", "salt"]).groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # Only labels that have a smaller one themselves lead on.
        used = step.select(F.col("label").alias("v")).distinct()
        jump = labels.filter("label < v").join(used, "v", "left_semi").select(F.col("v").alias("label"), F.col("label").alias("next"), salts.alias("salt"))
        new = table(step.withColumn("salt", salt("v")).join(jump, ["label", "salt"], "left").select("v", "old", F.coalesce("next", "label").alias("label")), "labels")
        labels = new.select("v", "label")
        if not new.filter("old <> label").limit(1).count():
            return labels
