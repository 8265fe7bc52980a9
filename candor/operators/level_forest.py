"""Isolation forest grown level by level in DataFrames: every draw is a digest, so SQL repeats it exactly."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.operators.forest import ForestConfig
from candor.schemas import FEATURE_COLUMNS
from candor.session import stored

EULER = 0.5772156649015329
_HEX_DIGITS = 13  # 52 bits, which a double holds exactly


def draw(*salt: Column) -> Column:
    """A number in [0, 1) from the texts of ``salt``."""
    digest = F.md5(F.concat_ws(":", *[s.cast("string") for s in salt]))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("long").cast("double") / float(1 << 4 * _HEX_DIGITS)


def _named(config: ForestConfig) -> Column:
    return F.lit(f"{config.name}:{config.seed}")


def _most_depth(rows: int) -> int:
    return math.ceil(math.log2(max(2, rows)))


def samples(data: DataFrame, config: ForestConfig) -> DataFrame:
    """``config, tree_id`` and features of the ``max_samples`` rows with the smallest draws of each tree.

    The ranking limits itself in every task before anything is shuffled, so a
    tree's window sees a bounded number of rows from each.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(config.n_estimators - 1)))
    rolled = (data.select("user_id", *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]).withColumn("tree_id", trees)
              .withColumn("roll", draw(_named(config), F.lit("row"), F.col("tree_id"), F.col("user_id"))))
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy("roll", "user_id"))
    return (rolled.withColumn("place", place).where(F.col("place") <= config.max_samples)
            .select(F.lit(config.name).alias("config"), "tree_id", F.array(*FEATURE_COLUMNS).alias("x")))


def grown(data: DataFrame, configs: list[ForestConfig]) -> DataFrame:
    """Nodes of all trees: ``config, tree_id, node_id, feature, threshold, size, depth``.

    The root is node 1, its children 2 n and 2 n + 1; a leaf has feature -1. All
    trees of all configurations go one level down per round: one aggregate over
    the sampled rows finds every node's bounds, one join moves the rows on. A cut
    leaves a row on both sides; rows up to the threshold go left. A node stays a
    leaf at the depth limit, with one row, or where no feature of its tree varies.
    ``data`` holds ``user_id`` and the prepared features without nulls.
    """
    rows, facts = None, {}
    for c in configs:
        part = samples(data, c)
        rows = part if rows is None else rows.unionByName(part)
        facts[c.name] = (_named(c), max(1, int(c.max_features * len(FEATURE_COLUMNS))))
    places = range(len(FEATURE_COLUMNS))
    rows = stored(rows.withColumn("node_id", F.lit(1).cast("long")), "forest-rows")
    sizes = {r.config: r.n for r in rows.groupBy("config", "tree_id").count().groupBy("config").agg(F.max("count").alias("n")).collect()}
    limit = {name: _most_depth(n) for name, n in sizes.items()}

    def by_config(values: dict[str, Column]) -> Column:
        out = F.lit(None)
        for name, value in values.items():
            out = F.when(F.col("config") == name, value).otherwise(out)
        return out

    salt = by_config({name: fact[0] for name, fact in facts.items()})
    chosen = by_config({name: F.transform(F.slice(F.array_sort(F.array(*[F.struct(
        draw(fact[0], F.lit("feature"), F.col("tree_id"), F.lit(i)).alias("u"), F.lit(i).alias("i")) for i in places])),
        1, fact[1]), lambda s: s["i"]) for name, fact in facts.items()})
    deepest = by_config({name: F.lit(n) for name, n in limit.items()})
    levels = None
    for depth in range(max(limit.values(), default=-1) + 1):
        nodes = rows.groupBy("config", "tree_id", "node_id").agg(F.count(F.lit(1)).cast("int").alias("size"), *[
            x for i in places for x in (F.min(F.col("x")[i]).alias(f"low{i}"), F.max(F.col("x")[i]).alias(f"high{i}"))])
        nodes = nodes.withColumn("usable", chosen)
        open_ = F.array_sort(F.filter(F.array(*[F.struct(
            draw(salt, F.lit("cut"), F.col("tree_id"), F.col("node_id"), F.lit(i)).alias("u"), F.lit(i).alias("i"),
            F.col(f"low{i}").alias("low"), F.col(f"high{i}").alias("high")) for i in places]),
            lambda s: (s["low"] < s["high"]) & F.array_contains(F.col("usable"), s["i"])))
        cut = F.when((F.lit(depth) < deepest) & (F.col("size") > 1), F.get(open_, F.lit(0)))
        at = F.col("s.low") + draw(salt, F.lit("at"), F.col("tree_id"), F.col("node_id")) * (F.col("s.high") - F.col("s.low"))
        nodes = stored(nodes.withColumn("s", cut).select(
            "config", "tree_id", "node_id", F.coalesce("s.i", F.lit(-1)).alias("feature"),
            F.when(at < F.col("s.high"), at).otherwise(F.col("s.low")).alias("threshold"), "size", F.lit(depth).alias("depth")), "forest-level")
        levels = nodes if levels is None else levels.unionByName(nodes)
        inner = nodes.where("feature >= 0").drop("size", "depth")
        if inner.isEmpty():
            break
        right = (F.get("x", F.col("feature")) > F.col("threshold")).cast("long")
        rows = stored(rows.join(inner, ["config", "tree_id", "node_id"]).select(
            "config", "tree_id", "x", (2 * F.col("node_id") + right).alias("node_id")), "forest-rows")
    if levels is None:
        raise ValueError("there are no complete users to grow trees from")
    return levels


def mean_path(n: Column) -> Column:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = n.cast("double")
    return F.when(n > 2, 2.0 * (F.log(n - 1.0) + F.lit(EULER)) - 2.0 * (n - 1.0) / n).when(n == 2, 1.0).otherwise(0.0)


def raw_scores(data: DataFrame, nodes: DataFrame, config: ForestConfig) -> DataFrame:
    """Adds ``raw_score`` by column expressions alone.

    Every row meets the trees as one array of nodes by tree and number: a
    broadcast of at most trees x 2^(depth + 1) places, whatever the data. It goes
    down each tree as an ``aggregate`` over depths and adds up path lengths.
    """
    own = nodes.where(F.col("config") == config.name)
    top = own.agg(F.max("depth").alias("depth"), F.max(F.when(F.col("node_id") == 1, F.col("size"))).alias("rows")).first()
    width = 1 << (top.depth + 1)
    place = F.col("tree_id") * width + F.col("node_id")
    listed = own.select(place.cast("int").alias("place"), F.struct(
        "feature", "threshold", (F.col("depth") + mean_path(F.col("size"))).alias("length")).alias("node"))
    packed = listed.agg(F.map_from_entries(F.collect_list(F.struct("place", "node"))).alias("by")).select(
        F.lit(0).alias("_one"), F.transform(F.sequence(F.lit(0), F.lit(config.n_estimators * width - 1)),
                                            lambda p: F.try_element_at("by", p)).alias("_nodes"))
    values = F.array(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])

    def end(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            at = F.get("_nodes", tree * width + node)
            right = (F.get("_values", at["feature"]) > at["threshold"]).cast("int")
            return F.when(at["feature"] < 0, node).otherwise(2 * node + right)
        return F.aggregate(F.sequence(F.lit(1), F.lit(top.depth)), F.lit(1), step) if top.depth else F.lit(1)

    total = F.aggregate(F.sequence(F.lit(0), F.lit(config.n_estimators - 1)), F.lit(0.0),
                        lambda sum_, tree: sum_ + F.get("_nodes", tree * width + end(tree))["length"])
    norm = F.when(mean_path(F.lit(top.rows)) > 0, mean_path(F.lit(top.rows))).otherwise(1.0)
    met = data.withColumns({"_one": F.lit(0), "_values": values}).join(F.broadcast(packed), "_one")
    return met.withColumn("raw_score", F.pow(F.lit(2.0), -(total / config.n_estimators) / norm)).drop("_one", "_values", "_nodes")
