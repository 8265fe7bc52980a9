from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candor.functions import quantiles
from candor.functions.quantiles import exact_quantiles
from candor.functions.ranking import global_row_number
from candor.functions.scalars import friend_count
from candor.operators import reports
from candor.schemas import require_columns
from candor.session import scratch_path
from candor.sources import tables


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, {"x": probs})["x"]
    known = [v for v in values if v is not None]
    want = list(np.quantile(known, probs)) if known else [None] * len(probs)
    assert got == (pytest.approx(want) if known else want)


@pytest.mark.parametrize("bracket", [(-5.0, -5.0), (2000.0, 3000.0), (-1e300, 1e300), (10.0, 20.0)])
def test_quantiles_survive_a_useless_sketch(spark, monkeypatch, bracket):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    real = quantiles._sketched

    def useless(frame, wanted):
        sizes, _ = real(frame, wanted)
        return sizes, {c: [quantiles.Bracket(*bracket, 0, [])] for c in wanted}

    monkeypatch.setattr(quantiles, "_sketched", useless)
    assert exact_quantiles(df, {"x": [0.0, 0.5, 1.0]})["x"] == [0.0, 499.5, 999.0]


@pytest.mark.parametrize("scale", ["powers", "negative powers", "both signs", "near one"])
def test_quantiles_without_any_help_take_few_rounds(spark, monkeypatch, scale):
    """One bracket over the whole column: values of all magnitudes, or a few steps of the last digit apart."""
    made = {"powers": [2.0 ** i for i in range(-1000, 1000, 7)],
            "negative powers": [-(3.0 ** i) for i in range(-600, 600, 5)],
            "both signs": [s * 10.0 ** i for s in (-1, 1) for i in range(-300, 301, 3)] + [0.0] * 5,
            "near one": [1.0 + i * 2.0 ** -52 for i in range(300)] + [1e9, -1e9]}[scale]
    df = spark.createDataFrame([(v,) for v in made], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]
    rounds = []
    count = quantiles._region_counts
    monkeypatch.setattr(quantiles, "_sketched", lambda frame, wanted: (
        {"x": len(made)}, {"x": [quantiles.Bracket(min(made), max(made), 0, [])]}))
    monkeypatch.setattr(quantiles, "_region_counts", lambda *a, **k: rounds.append(1) or count(*a, **k))
    got = exact_quantiles(df, {"x": probs})["x"]
    ranked, want = sorted(made), []
    for p in probs:
        place = p * (len(made) - 1)
        low, high = ranked[int(place)], ranked[min(len(made) - 1, -int(-place // 1))]
        want.append(low + (high - low) * (place - int(place)))
    assert got == pytest.approx(want, rel=1e-12, abs=0) and len(rounds) <= 8


def test_quantiles_with_one_value_on_most_rows(spark):
    """18 quantiles of six columns, nine tenths of the rows being one value: few scans, no window."""
    rare = F.pmod(F.xxhash64("id"), F.lit(9973)) / 3.0
    cols = {f"x{i}": F.when(F.pmod(F.col("id"), F.lit(10)) > 0, F.lit(float(i))).otherwise(rare * (i - 2)) for i in range(6)}
    df = spark.range(30_000).select(*[v.alias(c) for c, v in cols.items()])
    probs = [0.02, 0.5, 0.97]
    got = exact_quantiles(df, {c: probs for c in cols})
    pandas = df.toPandas()
    for c in cols:
        assert got[c] == pytest.approx(list(np.quantile(pandas[c], probs)))


def test_quantile_rounds_have_no_window_and_no_sort(spark, monkeypatch):
    plans, collect = [], type(spark.range(1)).collect

    def watched(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return collect(frame)

    monkeypatch.setattr(type(spark.range(1)), "collect", watched)
    df = spark.range(1000).select(*[(F.col("id") * i).cast("double").alias(f"x{i}") for i in range(1, 7)])
    exact_quantiles(df, {f"x{i}": [0.25, 0.5, 0.75] for i in range(1, 7)})
    rounds = [p for p in plans if "explode" in p]
    assert len(rounds) == 1 and not any("Window" in p or "Sort" in p for p in plans)


def test_quantiles_of_large_table(spark):
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("x"))
    got = exact_quantiles(df, {"x": [0.25, 0.5, 0.95]})["x"]
    want = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.95)))).first()[0]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("partitions", [1, 5])
def test_global_row_number_equals_one_partition(spark, partitions):
    df = spark.range(5000).select("id", F.pmod(F.xxhash64("id"), F.lit(100)).alias("x")).repartition(partitions)
    got = global_row_number(df, [F.desc("x"), F.col("id")], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [(r["x"], r["id"]) for r in got] == sorted(((r["x"], r["id"]) for r in got), key=lambda p: (-p[0], p[1]))


def test_global_row_number_has_one_single_partition_over_the_slice_counts(spark):
    df = spark.range(100).select("id")
    plan = global_row_number(df, [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # Below each such exchange the rows are counts per slice already.
    assert len(single) <= 1 and all(any("Aggregate" in x for x in lines[i + 1:i + 4]) for i in single)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    left = {r["bin"]: r["events"] for r in reports.histogram(df, "x", 4).collect()}
    right = {r["bin"]: r["events"] for r in reports.histogram(df, "x", 4, right_closed=True).collect()}
    assert left == {0: 1, 1: 1, 2: 1, 3: 2} and right == {0: 2, 1: 1, 2: 1, 3: 1}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r["bin"]: r["events"] for r in reports.histogram(flat, "x", 3).collect()} == {0: 2, 1: 0, 2: 0}


def test_profile_of_one_to_ten(spark):
    row = reports.profile(spark.range(1, 11), ["id"]).first()
    assert (row["count"], row["q25"], row["median"], row["q75"]) == (10, 3.25, 5.5, 7.75)


def test_require_columns(spark):
    with pytest.raises(ValueError, match="'b', 'c'"):
        require_columns(spark.range(1).select(F.col("id").alias("a")), ["a", "c", "b"])


def test_convert_raw_skips_absent_and_lays_reviews_out_by_year(spark):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "out")
    spark.createDataFrame([('{"review_id":"r1","user_id":"u","business_id":"b","stars":4,"date":"2019-05-06 07:08:09","text":" x "}',),
                           ('{"review_id":"r2","stars":"3","date":"2019-05-06 07:08:09","useful":7}',),
                           ("not json",)], "value string").coalesce(1).write.text(f"{raw}/review.json")
    spark.createDataFrame([('{"business_id":"b","name":"n","categories":"Restaurants"}',)], "value string"
                          ).write.text(f"{raw}/business.json")
    assert tables.convert_raw(spark, raw, out) == {"business": {"rows": 1, "corrupt": 0}, "review": {"rows": 2, "corrupt": 1}}
    got = sorted(spark.read.parquet(f"{out}/review").collect())
    assert [(r["review_id"], r["stars"], r["review_year"], r["useful"]) for r in got] == [("r1", 4.0, 2019, None), ("r2", 3.0, 2019, 7)]
    assert [r[tables.CORRUPT] for r in spark.read.parquet(f"{out}/_corrupt/review").collect()] == ["not json"]
    assert not tables.path_exists(spark, f"{out}/tip")


def test_friend_counts_of_all_forms(spark):
    texts = [None, "", " None ", "a", "a, b,c", "[]", '["a"]', '["a", "b, c"]', " [ ] "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, friends string")
    got = df.select("i", friend_count(df).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [0, 0, 0, 1, 3, 0, 1, 2, 0]
    lists = spark.createDataFrame([(None,), ([],), (["a", "b"],)], "friends array<string>")
    assert [r.n for r in lists.select(friend_count(lists).alias("n")).collect()] == [0, 0, 2]


def test_csv_returns_what_it_was_given(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, "  padded  "), (2, 'a "quoted", b'), (3, "two\nlines"), (4, None), (5, "back\\slash\\"), (6, ",")]
    df = spark.createDataFrame(rows, "i int, text string")
    tables.write_csv(df, path)
    assert sorted((r.i, r.text) for r in tables.read_csv(spark, path, df.schema).collect()) == rows


def test_quantiles_pass_over_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (3.0,), (float("inf"),)], "x double")
    assert exact_quantiles(df, {"x": [0.5]}) == {"x": [2.0]}
