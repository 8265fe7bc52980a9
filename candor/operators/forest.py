"""Isolation forest (Liu, Ting, Zhou 2008): users that few random cuts set apart.

Trees are grown side by side, each in its own task from at most 256 rows; the
users themselves are only filtered by a hash and later scored where they lie.
What travels is the node table, bounded by trees x (2 x 256 - 1) rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candor.functions.quantiles import exact_quantiles
from candor.functions.ranking import global_row_number
from candor.operators.prepare import coerce_numeric, drop_incomplete_users
from candor.schemas import FEATURE_COLUMNS, require_columns
from candor.session import stored


@dataclass(frozen=True)
class ForestConfig:
    """The defaults are the published model settings."""

    name: str = "full_features"
    contamination: float = 0.05
    n_estimators: int = 300
    max_features: float = 1.0
    seed: int = 42
    max_samples: int = 256


SWEEP = [ForestConfig(), ForestConfig("subsampled_features", max_features=0.7)]

ROWS_PER_TASK = 50_000

NODE_SCHEMA = ("config string, tree_id int, node_id int, feature int, threshold double, "
               "left int, right int, size int, depth int")


def median_impute(features: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Finite doubles with the exact column median where missing, zero if nothing is known."""
    numeric = coerce_numeric(features, columns)
    medians = exact_quantiles(numeric, {c: [0.5] for c in columns})
    return numeric.fillna({c: m[0] if m[0] is not None else 0.0 for c, m in medians.items()})


def model_input(features: DataFrame) -> DataFrame:
    """``user_id`` and the seven prepared features of all complete users."""
    require_columns(features, ["user_id", *FEATURE_COLUMNS], "user features")
    return median_impute(drop_incomplete_users(features).select("user_id", *FEATURE_COLUMNS))


def tree_samples(data: DataFrame, config: ForestConfig, n_rows: int) -> DataFrame:
    """``tree_id`` plus the rows drawn for it, without replacement.

    A draw depends on user id and seed alone, never on the partitioning. By the
    law at every size, each tree rolls for every row and takes the ``psi`` rows
    with the smallest rolls. Only rolls below a share that a tree's sample
    overshoots by six deviations are looked at: how many trees a row meets below
    it is one binomial draw, which trees is a hash order of all trees, so the
    work is that of the rows met and a row may serve any number of trees. Should
    a tree come out short, the share doubles, so every tree gets exactly ``psi``.
    """
    trees, psi = config.n_estimators, min(config.max_samples, n_rows)
    # A fixed number of slices: growing is costly per row, adaptive execution
    # would put these few rows into one task.
    slices = min(trees, 2 * data.sparkSession.sparkContext.defaultParallelism)
    share = min(1.0, (psi + 6 * math.sqrt(psi)) / n_rows)
    while True:
        met = _rows_met(data, trees, share, config.seed).repartition(slices, "tree_id")
        place = F.row_number().over(Window.partitionBy("tree_id").orderBy("_roll", "user_id"))
        picked = stored(met.withColumn("_place", place).filter(F.col("_place") <= psi).drop("_place", "_roll"), "samples")
        if share >= 1.0 or picked.count() == trees * psi:
            return picked.repartition(slices, "tree_id")
        share = min(1.0, 2 * share)


def _rows_met(data: DataFrame, trees: int, share: float, seed: int) -> DataFrame:
    """``tree_id, _roll`` and the row for every (tree, row) whose roll lies below ``share``."""
    scale = 1 << 40

    def roll(*salt: Column) -> Column:
        return F.pmod(F.xxhash64("user_id", *salt, F.lit(seed)), F.lit(scale)).cast("double") / scale

    # Distribution of the number of trees a row meets, up to where nothing is left of it.
    chance, upto, steps = (1.0 - share) ** trees if share < 1.0 else 0.0, 0.0, []
    for n in range(trees):
        upto += chance
        if share < 1.0 and upto > 1.0 - 1e-13 and n >= trees * share:
            break
        steps.append(upto)
        chance = math.comb(trees, n + 1) * share ** (n + 1) * (1.0 - share) ** (trees - n - 1)
    draw = F.filter(F.array(*[F.lit(x) for x in steps]), lambda x: x <= roll(F.lit("trees")))
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        F.xxhash64("user_id", t, F.lit(f"order{seed}")).alias("place"), t.alias("tree"))))
    found = data.withColumn("_n", F.size(draw)).filter("_n > 0")
    return (found.withColumn("tree_id", F.explode(F.transform(F.slice(order, F.lit(1), F.col("_n")), lambda s: s["tree"])))
            .withColumn("_roll", roll(F.col("tree_id"))).drop("_n"))


def grow_trees(data: DataFrame, configs: list[ForestConfig]) -> DataFrame:
    """Node table of all trees of all configurations."""
    n_rows = data.count()
    if not n_rows:
        raise ValueError("there are no complete users to grow trees from")
    grown = [_grow(data, c, n_rows) for c in configs]
    nodes = grown[0]
    for more in grown[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _grow(data: DataFrame, config: ForestConfig, n_rows: int) -> DataFrame:
    columns, name, seed = list(FEATURE_COLUMNS), config.name, config.seed
    n_features = max(1, int(config.max_features * len(columns)))
    max_depth = math.ceil(math.log2(max(2, min(config.max_samples, n_rows))))

    def grow(sample):
        import numpy as np
        import pandas as pd

        tree = int(sample["tree_id"].iloc[0])
        rows = sample.sort_values("user_id")[columns].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree])
        usable = rng.permutation(len(columns))[:n_features]
        nodes, todo = [], [(0, rows, 0)]
        next_id = 1
        while todo:
            node, part, depth = todo.pop()
            low, high = part[:, usable].min(axis=0), part[:, usable].max(axis=0)
            varying = usable[high > low]
            if depth >= max_depth or len(part) <= 1 or not len(varying):
                nodes.append((node, -1, 0.0, -1, -1, len(part), depth))
                continue
            feature = int(varying[rng.integers(len(varying))])
            values = part[:, feature]
            cut = rng.uniform(values.min(), values.max())
            goes_left = values <= cut
            nodes.append((node, feature, cut, next_id, next_id + 1, len(part), depth))
            todo += [(next_id, part[goes_left], depth + 1), (next_id + 1, part[~goes_left], depth + 1)]
            next_id += 2
        out = pd.DataFrame(sorted(nodes), columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree_id", tree)
        out.insert(0, "config", name)
        return out

    return tree_samples(data, config, n_rows).groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


def isolation_scores(data: DataFrame, nodes: DataFrame, config: ForestConfig) -> DataFrame:
    """Add ``raw_score`` in (0, 1]: near 1 for rows isolated by few cuts."""
    import numpy as np

    table = nodes.filter(F.col("config") == config.name).orderBy("tree_id", "node_id").toPandas()
    trees = int(table["tree_id"].max()) + 1
    width = int(table["node_id"].max()) + 1
    depth = int(table["depth"].max())
    where = (table["tree_id"].to_numpy(), table["node_id"].to_numpy())

    def grid(column, dtype):
        filled = np.zeros((trees, width), dtype=dtype)
        filled[where] = table[column].to_numpy()
        return filled

    def expected(n):
        """Mean path length of an unsuccessful search among n rows."""
        n = np.asarray(n, dtype="float64")
        long = 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2.0 * (n - 1) / np.maximum(n, 1)
        return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))

    leaf = grid("feature", "int32") < 0
    own = np.arange(width, dtype="int32")[None, :]
    forest = data.sparkSession.sparkContext.broadcast({
        "feature": np.where(leaf, 0, grid("feature", "int32")),
        "threshold": np.where(leaf, np.inf, grid("threshold", "float64")),
        # Leaves point to themselves, so all rows take the same number of steps.
        "left": np.where(leaf, own, grid("left", "int32")),
        "right": np.where(leaf, own, grid("right", "int32")),
        "length": grid("depth", "int32") + expected(grid("size", "int32")),
    })
    sample = int(table.loc[table["node_id"] == 0, "size"].max())
    norm = float(expected(sample)) or 1.0

    @F.pandas_udf("double")
    def raw_score(*features):
        import numpy as np
        import pandas as pd

        f = forest.value
        rows = np.column_stack([c.to_numpy(dtype="float64") for c in features])
        every = np.arange(len(rows))
        total = np.zeros(len(rows))
        for t in range(f["feature"].shape[0]):
            feature, threshold = f["feature"][t], f["threshold"][t]
            left, right = f["left"][t], f["right"][t]
            at = np.zeros(len(rows), dtype="int32")
            for _ in range(depth):
                at = np.where(rows[every, feature[at]] <= threshold[at], left[at], right[at])
            total += f["length"][t][at]
        return pd.Series(np.exp2(-(total / f["feature"].shape[0]) / norm))

    return data.withColumn("raw_score", raw_score(*[F.col(c) for c in FEATURE_COLUMNS]))


def flag_scores(ranked: DataFrame, contamination: float) -> DataFrame:
    """Shift the scores so that the wanted share lies above zero, and flag it.

    The threshold is the interpolated (1 - contamination) quantile. The table is
    already ranked, so it is read off the two ranks beside that place.
    """
    n = ranked.count()
    place = (1.0 - contamination) * (n - 1)
    low, high = n - math.floor(place), n - math.ceil(place)
    ends = {r["_rank"]: r["raw_score"] for r in
            ranked.filter(F.col("_rank").isin(low, high)).select("_rank", "raw_score").collect()}
    cut = ends[low] + (ends[high] - ends[low]) * (place - math.floor(place))
    return (
        ranked.withColumn("anomaly_score", F.col("raw_score") - F.lit(cut))
        .withColumn("is_anomaly", F.when(F.col("raw_score") > F.lit(cut), 1).otherwise(0))
    )


def user_anomaly_scores(features: DataFrame, config: ForestConfig = ForestConfig()) -> DataFrame:
    """Features, score, flag and rank of every complete user, most anomalous first.

    Rank 1 is the most anomalous; ties go by user id.
    """
    return _score_all(features, [config])[0].orderBy("anomaly_rank")


def _slices(spark: SparkSession, n_rows: int) -> int:
    """Tasks for scoring: its cost goes with rows x trees, so bytes are no measure of it."""
    return max(math.ceil(n_rows / ROWS_PER_TASK),
               min(spark.sparkContext.defaultParallelism, math.ceil(n_rows / 1000)), 1)


def _score_all(features: DataFrame, configs: list[ForestConfig]) -> list[DataFrame]:
    original = drop_incomplete_users(features).select("user_id", *FEATURE_COLUMNS)
    prepared = model_input(original)
    slices = _slices(features.sparkSession, prepared.count())
    data = stored(prepared.repartition(slices, "user_id"), "model-input")
    nodes = stored(grow_trees(data, configs), "trees")
    out = []
    for config in configs:
        # Written before it is ranked: a range sort reads its input twice.
        scored = stored(isolation_scores(data, nodes, config).select("user_id", "raw_score"), "raw-scores")
        ranked = global_row_number(scored, [F.desc("raw_score"), F.col("user_id")], "_rank")
        flagged = flag_scores(ranked, config.contamination).select(
            "user_id", "anomaly_score", "is_anomaly", F.col("_rank").alias("anomaly_rank"))
        out.append(original.join(flagged, "user_id"))
    return out


def config_scores(features: DataFrame, configs: list[ForestConfig] = SWEEP) -> DataFrame:
    """``config, user_id, anomaly_score, is_anomaly`` for every configuration."""
    out = None
    for config, scores in zip(configs, _score_all(features, configs)):
        part = scores.select(F.lit(config.name).alias("config"), F.lit(config.max_features).alias("max_features"),
                             "user_id", "anomaly_score", "is_anomaly")
        out = part if out is None else out.unionByName(part)
    return out


def anomaly_config_summary(scores: DataFrame) -> DataFrame:
    """One row per configuration: spread of the scores and number of flagged users."""
    return scores.groupBy("config", "max_features").agg(
        F.stddev_pop("anomaly_score").alias("score_std"),
        F.sum("is_anomaly").alias("n_anomalies"),
        F.avg("anomaly_score").alias("score_mean"),
        F.max("anomaly_score").alias("score_max"),
    )


def score_metrics(scores: DataFrame) -> DataFrame:
    """Run metrics of one scoring, one row."""
    return scores.agg(
        F.count(F.lit(1)).alias("n_users_scored"),
        F.sum("is_anomaly").alias("n_anomalies"),
        F.avg("is_anomaly").alias("anomaly_rate"),
        F.avg("anomaly_score").alias("anomaly_score_mean"),
        F.stddev_pop("anomaly_score").alias("anomaly_score_std"),
        F.max("anomaly_score").alias("anomaly_score_max"),
        F.min("anomaly_score").alias("anomaly_score_min"),
    )
