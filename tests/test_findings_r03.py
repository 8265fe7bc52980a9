"""Faults found in round 3, each on rows of its own."""

from __future__ import annotations

import glob
import json

import duckdb
from pyspark.sql import functions as F

from candor.operators import communities
from candor.operators.records import json_records
from candor.plans.registry import ORACLES, QUERIES, Inputs
from candor.session import scratch_root, stored

SF = "/root/testdata/sf0.001"


def test_planted_groups_stay_apart_however_many(spark, tmp_path):
    """Thirty groups of three: with equal weights joining neighbours would pay from nine groups on. One row comes twice."""
    ids = spark.range(90).select(F.expr("id div 3 * 40 + id % 3").alias("c_custkey"))
    ids.union(ids.filter("c_custkey = 40")).write.parquet(f"{tmp_path}/customer.parquet")
    got = QUERIES["planted_clusters"](spark, str(tmp_path)).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW customer AS SELECT DISTINCT c_custkey FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(db.execute(ORACLES["planted_clusters"]).fetchall())

def test_records_have_plain_numbers(spark):
    rows = spark.sql("""
        SELECT 0.0005D AS small, 12345678.0D AS large, -0.25D AS mid, CAST(NULL AS DOUBLE) AS gone, double('NaN') AS odd, 7 AS n,
               'say "5.0E-4",\\nthen' AS text, struct('a' AS name, CAST(NULL AS STRING) AS city) AS one,
               if(false, struct(1 AS x), NULL) AS none""")
    record = json_records(rows).first()["record"]
    assert record.startswith('{"small":0.0005,"large":12345678.0,"mid":-0.25,"gone":null,"odd":null,"n":7,"text":')
    assert json.loads(record) == {
        "small": 0.0005, "large": 12345678.0, "mid": -0.25, "gone": None, "odd": None, "n": 7,
        "text": 'say "5.0E-4",\nthen', "one": {"name": "a", "city": None}, "none": None}

def test_raw_lines_are_written_packed(spark):
    before = set(glob.glob(f"{scratch_root(spark)}/candor-json-*"))
    assert QUERIES["src_json_roundtrip"](spark, SF).collect()
    folder = (set(glob.glob(f"{scratch_root(spark)}/candor-json-*")) - before).pop()
    parts = glob.glob(f"{folder}/part-*")
    assert parts and all(p.endswith(".gz") for p in parts)


def test_a_round_of_communities_is_one_table_and_shuffles_no_arc(spark, monkeypatch):
    """Before, a round wrote its totals beside its labels, and asked again after it took moves back."""
    written, rounds = [], []

    def listed(df, label, path=None):
        written.append(label)
        if label == "labels":
            rounds.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label, path)

    monkeypatch.setattr(communities, "stored", listed)
    edges = stored(Inputs(spark, SF).graph(), "graph")
    found = communities.louvain_communities(edges).collect()
    levels = written.count("level-arcs")
    assert rounds and levels and len(written) - len(rounds) <= 2 + 4 * levels
    # The first round of a level deals the arcs out; beside the kept arcs only totals are shuffled from then on.
    assert all("InMemoryTableScan" in plan for plan in rounds)
    assert sum(plan.count("ENSURE_REQUIREMENTS") == 1 for plan in rounds) >= len(rounds) - levels

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        assert sorted(communities.louvain_communities(edges).collect()) == sorted(found)
    finally:
        spark.conf.set(threshold, before)
