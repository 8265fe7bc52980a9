"""The step runner over tables on disk, from raw JSON to the last table."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from candor.__main__ import RULE, STEPS, parser, run
from candor.session import scratch_path, scratch_scope, stored
from candor.sources import star_views as views
from candor.sources import tables
from conftest import SF


def test_all_steps_in_order(spark):
    root = scratch_path(spark, "steps")
    as_text = {c: F.col(c).cast("string") for c in ("user_id", "business_id")}
    raw = {"review": views.raw_reviews(spark, SF).withColumns(as_text),
           "user": views.raw_users(spark, SF).withColumn("user_id", as_text["user_id"]),
           "business": views.businesses(spark, SF).withColumn("business_id", as_text["business_id"])}
    for name, df in raw.items():
        df.write.json(f"{root}/raw/dump_{name}.json")
    run(parser().parse_args(["convert-raw", "--raw_dir", f"{root}/raw", "--out_dir", root, "--prefix", "dump_"]), spark)

    outputs = {
        "restaurants-base": "restaurants_base", "reviews-base": "reviews_base", "users-base": "users_base",
        "restaurant-reviews": "restaurant_reviews", "review-features": "review_features",
        "user-features": "user_features", "rule-scores": "rule_based_scores", "user-anomaly": "user_anomaly_scores",
        "model-scores": "model_scores", "model-comparison": "model_comparison", "score-metrics": "score_metrics",
        "review-spikes": "review_spikes", "similarity-edges": "user_similarity_edges",
        "user-clusters": "user_clusters", "suspicious-businesses": "suspicious_businesses",
        "rating-impact": "rating_impact", "volume-impact": "volume_impact", "cases": "cases", "case-impact": "case_impact",
        **{s: s.replace("-", "_") for s in (
            "business-authenticity", "business-card", "business-impact", "top-cases", "top-users", "top-businesses",
            "bots", "bombers", "volume-increases", "volume-decreases", "growth-cases", "strong-cases")}}
    extra = {"user-features": ["--as_of", views.AS_OF],
             "top-users": ["--limit", "50"],
             "review-spikes": ["--min_reviews", "4", "--ratio_threshold", "2.0", "--abs_increase_threshold", "3.0"]}
    assert set(outputs) == set(STEPS)
    rows = {}
    for step, name in outputs.items():
        args = [step, "--output", f"{root}/{name}"] + extra.get(step, [])
        for table in STEPS[step][0]:
            args += [f"--{table}", f"{root}/{table}"]
        run(parser().parse_args(args), spark)
        rows[name] = spark.read.parquet(f"{root}/{name}").count()
    assert rows["restaurant_reviews"] == rows["review_features"] == 5772
    assert rows["review_spikes"] == 3439
    assert rows["suspicious_businesses"] == rows["rating_impact"] == rows["volume_impact"] == 27
    assert rows["user_features"] == rows["rule_based_scores"] > rows["user_anomaly_scores"] > 0
    assert rows["model_comparison"] == 2 and rows["score_metrics"] == 1
    assert rows["case_impact"] == rows["cases"] and rows["business_impact"] == 27
    assert rows["business_authenticity"] == rows["business_card"] == rows["restaurants_base"]
    assert rows["top_cases"] == min(25, rows["cases"]) and rows["top_businesses"] == 27 and rows["bots"] <= 10
    assert 0 < rows["volume_increases"] <= 5 and 0 < rows["volume_decreases"] <= 5

    # The same results as text, and the record of one business alone.
    def again(step, *more):
        args = [step, "--output", f"{root}/again-{step}", *more]
        for table in STEPS[step][0]:
            args += [f"--{table}", f"{root}/{table}"]
        run(parser().parse_args(args), spark)
        return f"{root}/again-{step}"

    kept = spark.read.parquet(f"{root}/case_impact")
    assert (tables.read_csv(spark, again("case-impact", "--format", "csv"), kept.schema).exceptAll(kept).isEmpty())
    wanted = spark.read.parquet(f"{root}/business_impact").first()["business_id"]
    lines = [json.loads(r.value) for r in spark.read.text(
        again("business-impact", "--ids", wanted, "--format", "json")).collect()]
    assert lines and all(x["business_id"] == wanted and x["business"]["name"] for x in lines)


def test_whole_run_takes_the_rule_and_the_window():
    args = parser().parse_args(["analyse", "--parquet_dir", "a", "--out_dir", "b", "--window_days", "3",
                                "--baseline_days", "20", "--ratio_threshold", "2.5"])
    rule = {o: getattr(args, f"rule_{o}") for o in RULE}
    assert args.window_days == 3
    assert rule == {**RULE, "window_days": 20, "ratio_threshold": 2.5}


def test_scratch_goes_with_its_scope_and_settings_stay(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    kept = stored(spark.range(3), "kept")
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        stored(spark.range(5), "inner", inner)
        assert tables.path_exists(spark, inner)
    assert not tables.path_exists(spark, inner)
    assert kept.count() == 3 and spark.conf.get("spark.checkpoint.dir", None) == before


def test_ids_of_a_business_lookup_reach_the_scan(spark, tmp_path):
    from candor.operators import authenticity

    rows = spark.range(1000).selectExpr("id AS business_id", "date '2020-01-01' AS spike_date", "id * 2 AS x")
    for kind, wanted in (("long", [7, "8", "none"]), ("string", ["7", 8])):
        path = str(tmp_path / kind)
        rows.withColumn("business_id", rows.business_id.cast(kind)).orderBy("business_id").write.parquet(path)
        found = authenticity._with_ids(spark.read.parquet(path), wanted)
        assert sorted(str(r.business_id) for r in found.collect()) == ["7", "8"]
        pushed = [x for x in found._jdf.queryExecution().toString().splitlines() if "PushedFilters" in x]
        assert pushed and all("business_id" in x.split("PushedFilters")[1] and "7" in x for x in pushed)
