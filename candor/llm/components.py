"""Connected components of a link table, by contracting it in rounds of joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.session import stored


def _roots(labels: DataFrame) -> DataFrame:
    """Follows ``(v, c)`` to the end of every chain; each pass doubles the steps taken."""
    while True:
        step = labels.select(F.col("v").alias("c"), F.col("c").alias("next"))
        labels = stored(labels.select("v", "c").join(step, "c")
                        .select("v", F.col("next").alias("c"), (F.col("next") < F.col("c")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("v", "c")


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(v, component)`` for every vertex of ``links``: the smallest vertex reachable.

    In each round every vertex points to its smallest neighbour, if that is
    smaller; chains of pointers collapse to their ends; links are rewritten to
    those ends, and only different ends, each pair once, go to the next round. So
    a dense group costs its links once. A vertex with many links meets them in a
    join of stored tables, which adaptive execution splits, and in a minimum that
    is reduced before the shuffle. The driver sees one flag a pass. Links with a
    null end or between a vertex and itself give no row beside it; no links give
    an empty table.
    """
    pairs = links.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    pairs = stored(pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()), "links")
    found = None
    while True:
        ends = pairs.select(F.col("a").alias("v"), F.col("b").alias("w")).union(pairs.select("b", "a"))
        labels = stored(ends.groupBy("v").agg(F.min("w").alias("low")).select("v", F.least("v", "low").alias("c")), "labels")
        labels = _roots(labels)
        ahead = labels.select(F.col("v").alias("component"), F.col("c").alias("root"))
        found = stored(labels.withColumnRenamed("c", "component") if found is None else
                       found.join(ahead, "component", "left").select("v", F.coalesce("root", "component").alias("component")),
                       "components")
        a, b = labels.select(F.col("v").alias("a"), F.col("c").alias("ra")), labels.select(F.col("v").alias("b"), F.col("c").alias("rb"))
        pairs = stored(pairs.join(a, "a").join(b, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if pairs.isEmpty():
            return found
