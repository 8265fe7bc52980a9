from __future__ import annotations

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from candor.operators import communities, forest, graph
from candor.plans.registry import QUERIES, Inputs
from candor.schemas import FEATURE_COLUMNS
from candor.session import stored
from conftest import SF


# ---- co-review pairs ------------------------------------------------------------------------------

def _brute_force(rows):
    out = []
    for a, b in itertools.combinations(sorted(rows), 2):
        gap = abs((a[3] - b[3]).total_seconds())
        if a[2] == b[2] and gap < 7 * 86400:
            out.append((a[0], b[0], a[1], b[1], a[2], int(gap // 86400)))
    return sorted(out)


@pytest.mark.parametrize("cell_rows", [4_000, 5, 1])
def test_pairs_equal_brute_force(spark, cell_rows):
    start = dt.datetime(1969, 12, 20)
    rows = [(f"r{(i * 7919) % 1000:03d}", i % 9, "hot" if i % 3 else f"b{i % 5}",
             start + dt.timedelta(hours=(i * i * 31) % 900)) for i in range(150)]
    df = spark.createDataFrame(rows, "review_id string, user_id long, business_id string, date timestamp_ntz")
    got = sorted(tuple(r) for r in graph.co_review_pairs(df, cell_rows=cell_rows).collect())
    assert got == _brute_force(rows) and got


def test_gap_of_seven_days_is_out(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [("a", 1, "b", t), ("b", 2, "b", t + dt.timedelta(days=6, hours=23)), ("c", 3, "b", t + dt.timedelta(days=7))]
    df = spark.createDataFrame(rows, "review_id string, user_id long, business_id string, date timestamp_ntz")
    got = {(r["review_id_a"], r["review_id_b"]): r["time_diff_days"] for r in graph.co_review_pairs(df).collect()}
    assert got == {("a", "b"): 6, ("b", "c"): 0}


def test_gap_ignores_changes_of_clocks(spark):
    """One microsecond under seven days across a spring-forward night, whatever the session zone."""
    t = dt.datetime(2021, 3, 10, 12)
    rows = [("a", 1, "b", t), ("b", 2, "b", t + dt.timedelta(days=7) - dt.timedelta(microseconds=1)),
            ("c", 3, "b", t + dt.timedelta(days=7))]
    df = spark.createDataFrame(rows, "review_id string, user_id long, business_id string, date timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {(r["review_id_a"], r["review_id_b"]) for r in graph.co_review_pairs(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {("a", "b"), ("b", "c")}


def test_pairs_do_not_depend_on_cell_size(spark):
    i = Inputs(spark, SF)
    flagged = stored(graph.flagged_reviews(i.reviews(), i.flags()), "flagged")
    one, many = graph.co_review_pairs(flagged), graph.co_review_pairs(flagged, cell_rows=3)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0 and one.count() == 184


# ---- communities ----------------------------------------------------------------------------------

def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "user_a long, user_b long")


def _ring(cliques=8, size=6):
    pairs = []
    for c in range(cliques):
        members = [c * size + i for i in range(size)]
        pairs += list(itertools.combinations(members, 2))
        pairs.append((members[-1], ((c + 1) % cliques) * size))
    return pairs


def test_ring_of_cliques_is_recovered(spark):
    members = communities.louvain_communities(_edges(spark, _ring()))
    groups = {}
    for r in members.collect():
        groups.setdefault(r["community"], set()).add(r["vertex"])
    assert sorted(map(sorted, groups.values())) == [[c * 6 + i for i in range(6)] for c in range(8)]
    q = communities.modularity(_edges(spark, _ring()), members).first()[0]
    assert q == pytest.approx(0.8125)


def test_small_graphs_and_clusters(spark):
    edges = _edges(spark, [(1, 2), (2, 3), (1, 3), (11, 12), (12, 13), (11, 13), (21, 22), (31, 31), (2, 1)])
    members = stored(communities.louvain_communities(edges), "members")
    assert members.count() == members.select("vertex").distinct().count() == 9
    clusters = communities.user_clusters(members).orderBy("user_id").collect()
    assert [(r["user_id"], r["cluster_id"], r["cluster_size"]) for r in clusters] == [
        (1, 0, 3), (2, 0, 3), (3, 0, 3), (11, 1, 3), (12, 1, 3), (13, 1, 3)]


def test_only_self_edges(spark):
    got = communities.louvain_communities(_edges(spark, [(5, 5), (6, 6)])).collect()
    assert sorted((r["vertex"], r["community"]) for r in got) == [(5, 5), (6, 6)]


def test_communities_of_the_review_graph(spark):
    edges = stored(Inputs(spark, SF).graph(), "graph")
    members = stored(communities.louvain_communities(edges), "members")
    users = edges.select(F.explode(F.array("user_a", "user_b")).alias("vertex")).distinct()
    assert members.count() == users.count() == members.join(users, "vertex").count()
    alone = users.select("vertex", F.col("vertex").alias("community"))
    together = users.select("vertex", F.lit(0).alias("community"))
    q = communities.modularity(edges, members).first()[0]
    assert q >= communities.modularity(edges, alone).first()[0]
    assert q >= communities.modularity(edges, together).first()[0] - 1e-9


# ---- isolation forest -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def features(spark):
    return stored(Inputs(spark, SF).features(), "features")


@pytest.fixture(scope="module")
def big(spark):
    """1,500 users around a centre and one far away."""
    near = [F.pmod(F.xxhash64("user_id", F.lit(c)), F.lit(1000)) / 1000.0 for c in FEATURE_COLUMNS]
    rows = spark.range(1500).select(F.col("id").alias("user_id"),
                                    *[n.alias(c) for n, c in zip(near, FEATURE_COLUMNS)])
    far = spark.range(1).select(F.lit(999_999).cast("long").alias("user_id"),
                                *[F.lit(50.0).alias(c) for c in FEATURE_COLUMNS])
    return stored(rows.unionByName(far), "big")


def test_trees(spark, big):
    data = stored(forest.model_input(big), "input")
    nodes = stored(forest.grow_trees(data, forest.SWEEP), "nodes")
    for config in ("full_features", "subsampled_features"):
        n = nodes.filter(F.col("config") == config)
        assert n.select("tree_id").distinct().count() == 300
        roots = n.filter("node_id = 0").agg(F.min("size"), F.max("size")).first()
        assert tuple(roots) == (256, 256)
        leaves = n.filter("feature < 0").groupBy("tree_id").agg(F.sum("size").alias("s")).select("s").distinct().collect()
        assert [r["s"] for r in leaves] == [256]
        assert n.agg(F.max("depth")).first()[0] <= 8
        used = n.filter("feature >= 0").groupBy("tree_id").agg(F.countDistinct("feature").alias("k"))
        assert used.agg(F.max("k")).first()[0] <= (7 if config == "full_features" else 4)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_trees_do_not_depend_on_partitioning(spark, big, partitions):
    config = forest.ForestConfig(n_estimators=20)
    data = stored(forest.model_input(big), "input")
    base = forest.grow_trees(data, [config])
    other = forest.grow_trees(data.repartition(partitions), [config])
    assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


@pytest.mark.parametrize("n", [100, 1_500, 400_000])
def test_every_tree_gets_a_full_sample_at_every_size(spark, n):
    data = spark.range(n).withColumnRenamed("id", "user_id")
    config = forest.ForestConfig(n_estimators=20, max_samples=256)
    sample = forest.tree_samples(data, config, n)
    want = min(256, n)
    assert {r["tree_id"]: r["count"] for r in sample.groupBy("tree_id").count().collect()} == dict.fromkeys(range(20), want)
    assert sample.distinct().count() == 20 * want
    shared = sample.groupBy("user_id").count().filter("count > 1").count()
    # Pairs of trees that meet in a row: 190 * 256^2 / n of them are expected.
    assert shared > 0 if n < 400_000 else shared < 100


def test_scores_flags_and_ranks(spark, big):
    scores = stored(forest.user_anomaly_scores(big), "scores")
    rows = scores.orderBy("anomaly_rank").collect()
    n = len(rows)
    assert n == 1501
    assert [r["anomaly_rank"] for r in rows] == list(range(1, n + 1))
    assert all(a["anomaly_score"] >= b["anomaly_score"] for a, b in zip(rows, rows[1:]))
    assert rows[0]["user_id"] == 999_999
    # Strictly above the interpolated quantile; the row at an integral place is not flagged.
    assert sum(r["is_anomaly"] for r in rows) == n - 1 - math.floor(0.95 * (n - 1))
    assert all((r["anomaly_score"] > 0) == (r["is_anomaly"] == 1) for r in rows)
    assert all(-1 < r["anomaly_score"] <= 1 for r in rows)


def test_flags_of_a_ranked_table(spark):
    """By the published rule, N - 1 - floor(0.95 (N - 1)) of N distinct scores lie above the threshold."""
    n = 2_001
    data = spark.range(n).selectExpr("id AS user_id", "id / 5000D AS raw_score", f"{n} - id AS _rank")
    flagged = forest.flag_scores(data, 0.05)
    assert flagged.filter("is_anomaly = 1").count() == n - 1 - math.floor(0.95 * (n - 1))



def test_incomplete_users_are_not_scored(spark, features):
    scored = forest.user_anomaly_scores(features)
    complete = features.filter("account_age_days IS NOT NULL AND num_friends IS NOT NULL").count()
    assert 0 < scored.count() == complete < features.count()


def test_sweep_summary(spark, features):
    rows = forest.anomaly_config_summary(forest.config_scores(features)).collect()
    assert {(r["config"], r["max_features"]) for r in rows} == {("full_features", 1.0), ("subsampled_features", 0.7)}
    assert all(r["n_anomalies"] > 0 and r["score_std"] > 0 for r in rows)


def test_full_chain(spark):
    rows = QUERIES["full_chain_authenticity"](spark, SF).collect()
    assert rows and all(r["authenticity_score"] in range(0, 101, 20) for r in rows)
    assert all((r["authenticity_score"] >= 50) == (r["is_suspicious"] == 1) for r in rows)


def test_level_forest_scores_equal_the_array_scorer(spark):
    import random

    from candor.operators import level_forest
    from candor.schemas import FEATURE_COLUMNS

    pick = random.Random(4)
    rows = [(i, *[float(pick.choice([0, 1, 2, pick.gauss(0, 3)])) for _ in FEATURE_COLUMNS]) for i in range(300)]
    data = spark.createDataFrame(rows, "user_id long, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS))
    configs = [forest.ForestConfig("a", n_estimators=7, max_samples=32), forest.ForestConfig("b", n_estimators=5, max_features=0.3, seed=1)]
    nodes = level_forest.grown(data, configs)
    table = nodes.toPandas()
    for c in configs:
        own = table[table["config"] == c.name]
        assert (own[own["node_id"] == 1]["size"] == min(c.max_samples, 300)).all() and own["tree_id"].nunique() == c.n_estimators
        by = {(t, n): (f, z) for t, n, f, z in own[["tree_id", "node_id", "feature", "size"]].itertuples(index=False)}
        assert all(z == by[t, 2 * n][1] + by[t, 2 * n + 1][1] for (t, n), (f, z) in by.items() if f >= 0)
        assert all(len({f for (t, _), (f, _) in by.items() if t == tree and f >= 0}) <= max(1, int(7 * c.max_features)) for tree in range(c.n_estimators))
        arrays = nodes.selectExpr("config", "tree_id", "int(node_id - 1) AS node_id", "feature", "threshold",
                                  "int(2 * node_id - 1) AS left", "int(2 * node_id) AS right", "size", "depth")
        want = {r.user_id: r.raw_score for r in forest.isolation_scores(data, arrays, c).collect()}
        got = {r.user_id: r.raw_score for r in level_forest.raw_scores(data, nodes, c).collect()}
        assert len(got) == 300 and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    again = {tuple(r) for r in level_forest.grown(data.repartition(5), configs).collect()}
    assert again == {tuple(r) for r in nodes.collect()}
