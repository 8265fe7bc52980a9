"""Communities by modularity, as rounds of joins and aggregates.

The method is that of Blondel et al. (2008): vertices move to the neighbouring
community with the largest gain, then communities become the vertices of a
smaller graph, and so on until nothing moves. Here all vertices look at the
same time. A hash gate, drawn anew every round, admits three of four, so that
two vertices do not swap for ever, and a round that lowers modularity is taken
back.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candor.functions.ranking import global_row_number
from candor.session import scratch_path, stored

# Smallest cluster reported.
MIN_CLUSTER_SIZE = 3

# A level ends when nothing gains, or after this many rounds in a row that
# raised modularity by less than the tolerance. Accepted rounds never lower it,
# so the search ends by itself and has no other limit.
_PATIENCE = 4


def louvain_communities(edges: DataFrame, weight: str | None = None, seed: int = 42,
                        tolerance: float = 1e-7) -> DataFrame:
    """``vertex, community`` for an undirected edge table ``user_a, user_b [, weight]``.

    Repeated edges count once unless a weight column is named. The state of
    every round is a table in shared storage; the driver sees a few totals per
    round and never a label.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    simple = edges.groupBy(F.least("user_a", "user_b").alias("a"), F.greatest("user_a", "user_b").alias("b")).agg(
        (F.sum(w) if weight else F.first(w)).alias("w"))
    both = F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")),
                   F.struct(F.col("b").alias("v"), F.col("a").alias("u")))
    ends = stored(simple.select(F.explode(both).alias("e"), "w").select("e.v", "e.u", "w"), "arcs")
    # A self-edge appears twice in ``ends`` and counts twice in the degree.
    nodes = stored(ends.groupBy("v").agg(
        F.sum("w").alias("k"), F.sum(F.when(F.col("v") == F.col("u"), F.col("w")).otherwise(0.0)).alias("inner")
    ), "nodes")
    arcs = ends.filter("v <> u")
    total = nodes.agg(F.sum("k")).first()[0]
    members = nodes.select(F.col("v").alias("vertex"), F.col("v").alias("community"))
    if not total:
        return members

    for level in count():
        labels, moved = _settle(arcs, nodes, total, seed + level, tolerance)
        if not moved:
            return members
        members = stored(
            members.join(labels.select(F.col("v").alias("community"), F.col("c").alias("_up")), "community")
            .select("vertex", F.col("_up").alias("community")), "members")
        arcs, nodes = _contract(arcs, labels)


def _settle(arcs: DataFrame, nodes: DataFrame, total: float, seed: int, tolerance: float):
    """Move vertices of one level until nothing gains. Returns (v, k, inner, c) and whether any moved."""
    spark = arcs.sparkSession
    slots = [scratch_path(spark, f"labels{i}") for i in range(2)]
    around = _neighbourhoods(arcs, nodes)
    labels = nodes.select("v", "k", F.col("v").alias("c"))
    best, best_q, stale, turn = None, float("-inf"), 0, 0
    try:
        for written in count():
            found, q, wishes = _judged(_options(around, labels, total), total, slots[written % 2])
            if q < best_q - 1e-12:
                # The last moves did harm: go back and try with another gate. What the
                # vertices wish there is known, so the turn that would ask again is only counted.
                slots.reverse()
                turn, stale = turn + 1, stale + 2
                if stale >= _PATIENCE:
                    break
            else:
                stale = 0 if q > best_q + tolerance else stale + 1
                best, best_q = found, max(q, best_q)
                if not wishes or stale >= _PATIENCE:
                    break
            labels = best.select("v", "k",
                                 F.when(_gate(seed, turn), F.col("goal")).otherwise(F.col("c")).alias("c"))
            turn += 1
    finally:
        around.unpersist()
    best = best.select("v", "k", "inner", "c")
    return best, not best.filter("c <> v").isEmpty()


def _gate(seed: int, turn: int):
    return F.pmod(F.xxhash64("v", F.lit(seed), F.lit(turn)), F.lit(4)) != 0


# Rows of a neighbourhood table that one task reads in a round.
_TASK_ARCS = 100_000


def _neighbourhoods(arcs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The arcs of a level, dealt out by their vertex and kept by the executors until released.

    Neither arcs nor degrees change within a level, so they are dealt out once; what
    an executor loses is made again from the stored table. While Spark can broadcast
    the labels, no round after the first shuffles an arc. Arcs carry the degree of
    their vertex. An arc of no weight from every vertex to itself, the only one with
    an inner weight, lets the vertex's own community always compete, also without a
    neighbour in it.
    """
    both = arcs.join(nodes.select("v", "k"), "v").select("v", "u", "w", "k", F.lit(None).cast("double").alias("inner"))
    own = nodes.select("v", F.col("v").alias("u"), F.lit(0.0).alias("w"), "k", "inner")
    table = stored(both.unionByName(own), "level-arcs")
    return table.repartition(1 + table.count() // _TASK_ARCS, "v").persist()


def _options(around: DataFrame, labels: DataFrame, total: float) -> DataFrame:
    """Per vertex the best community, ties to the smaller label, given the labels of the round's start.

    One job. Links are summed per (vertex, community); where tables are too large
    to broadcast, links and options are summed before they are shuffled, and
    adaptive execution splits a community with a large share of the links.
    """
    links = (around.join(labels.select(F.col("v").alias("u"), "c"), "u").groupBy("v", "c")
             .agg(F.sum("w").alias("link"), F.max("k").alias("k"), F.max("inner").alias("inner")))
    totals = labels.groupBy("c").agg(F.sum("k").alias("tot"))
    home = F.col("inner").isNotNull()
    others = F.col("tot") - F.when(home, F.col("k")).otherwise(0.0)
    options = links.join(totals, "c").withColumn("score", F.col("link") - F.col("k") * others / total)
    own = {"c": "c", "stay": "score", "own_link": "link", "own_tot": "tot"}
    chosen = options.groupBy("v").agg(
        F.max("k").alias("k"), F.max("inner").alias("inner"),
        *[F.max(F.when(home, F.col(of))).alias(name) for name, of in own.items()],
        F.min(F.struct((-F.col("score")).alias("loss"), "c")).alias("top"))
    wishes = -F.col("top.loss") > F.col("stay") + 1e-12
    return chosen.select("v", "k", "inner", "c", "own_link", "own_tot", wishes.alias("wishes"),
                         F.when(wishes, F.col("top.c")).otherwise(F.col("c")).alias("goal"))


def _judged(options: DataFrame, total: float, path: str) -> tuple[DataFrame, float, int]:
    """Write a round. Also the modularity of the labels it started from, and how many vertices would gain.

    Both are totals over the written rows, observed while they are written: the
    squares of the community totals are k times the own total, vertex by vertex.
    """
    seen = Observation()
    written = stored(options.observe(
        seen,
        (F.sum(F.col("own_link") + F.col("inner")) / total
         - F.sum(F.col("k") * F.col("own_tot")) / (total * total)).alias("q"),
        F.count_if("wishes").alias("wishes")), "labels", path)
    return written, seen.get["q"], seen.get["wishes"]


def _contract(arcs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Communities become vertices; links inside one become its inner weight."""
    name = labels.select("v", "c")
    merged = stored(
        arcs.join(name.withColumnRenamed("c", "cv"), "v")
        .join(name.select(F.col("v").alias("u"), F.col("c").alias("cu")), "u")
        .groupBy(F.col("cv").alias("v"), F.col("cu").alias("u")).agg(F.sum("w").alias("w")), "arcs")
    inner = merged.filter("v = u").select("v", F.col("w").alias("linked"))
    nodes = stored(
        labels.groupBy(F.col("c").alias("v")).agg(F.sum("k").alias("k"), F.sum("inner").alias("inner"))
        .join(inner, "v", "left")
        .select("v", "k", (F.col("inner") + F.coalesce("linked", F.lit(0.0))).alias("inner")), "nodes")
    return merged.filter("v <> u"), nodes


def modularity(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Modularity of a labelling of the unweighted simple graph, one row."""
    pairs = edges.select(F.least("user_a", "user_b").alias("a"), F.greatest("user_a", "user_b").alias("b")).distinct()
    of = members.select(F.col("vertex").alias("a"), F.col("community").alias("ca"))
    to = members.select(F.col("vertex").alias("b"), F.col("community").alias("cb"))
    labelled = pairs.join(of, "a").join(to, "b")
    ends = labelled.select(F.explode(F.array("ca", "cb")).alias("c"),
                           F.when(F.col("ca") == F.col("cb"), 1.0).otherwise(0.0).alias("inside"))
    per = ends.groupBy("c").agg(F.count(F.lit(1)).alias("tot"), F.sum("inside").alias("inside"))
    m2 = pairs.agg(2.0 * F.count(F.lit(1))).scalar()
    return per.agg(F.sum(F.col("inside") / m2 - F.pow(F.col("tot") / m2, 2)).alias("modularity"))


def user_clusters(members: DataFrame, min_size: int = MIN_CLUSTER_SIZE) -> DataFrame:
    """``user_id, cluster_id, cluster_size`` for communities of at least ``min_size``.

    Ids are dense from 0, by smallest member.
    """
    sizes = (members.groupBy("community")
             .agg(F.count(F.lit(1)).alias("cluster_size"), F.min("vertex").alias("_first"))
             .filter(F.col("cluster_size") >= min_size))
    numbered = global_row_number(sizes, [F.col("_first")], "_number")
    return members.join(numbered, "community").select(
        F.col("vertex").alias("user_id"), (F.col("_number") - 1).alias("cluster_id"), "cluster_size")
