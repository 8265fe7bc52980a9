"""Run one step over tables on disk: ``python -m candor STEP --help``."""

from __future__ import annotations

import argparse

from candor.operators import (
    authenticity, communities, features, forest, graph, impact, prepare, records, reports, rules, spikes)
from candor.plans.chain import analyse
from candor.session import build_session, scratch_scope
from candor.sources import tables

# step -> (input tables, options with defaults, (inputs, options) -> result)
STEPS = {
    "restaurants-base": (["business"], {}, lambda t, o: prepare.restaurants_base(t["business"])),
    "reviews-base": (["review"], {}, lambda t, o: prepare.reviews_base(t["review"])),
    "users-base": (["user"], {}, lambda t, o: prepare.users_base(t["user"])),
    "restaurant-reviews": (["reviews_base", "restaurants_base"], {}, lambda t, o: prepare.restaurant_reviews(
        t["reviews_base"], t["restaurants_base"])),
    "review-features": (["restaurant_reviews", "users_base"], {}, lambda t, o: features.review_features(
        t["restaurant_reviews"], t["users_base"])),
    "user-features": (["restaurant_reviews", "users_base"], {"as_of": ""}, lambda t, o: features.user_features(
        t["restaurant_reviews"], t["users_base"], o["as_of"] or None)),
    "rule-scores": (["user_features"], {}, lambda t, o: rules.rule_based_scores(t["user_features"])),
    "user-anomaly": (["user_features"], {}, lambda t, o: forest.user_anomaly_scores(
        t["user_features"])),
    "model-scores": (["user_features"], {}, lambda t, o: forest.config_scores(t["user_features"])),
    "model-comparison": (["model_scores"], {}, lambda t, o: forest.anomaly_config_summary(t["model_scores"])),
    "score-metrics": (["user_anomaly_scores"], {}, lambda t, o: forest.score_metrics(t["user_anomaly_scores"])),
    "review-spikes": (
        ["restaurant_reviews"],
        {"window_days": 30, "min_history_days": 30, "min_reviews": 5, "ratio_threshold": 3.0,
         "abs_increase_threshold": 5.0},
        lambda t, o: spikes.review_spikes(t["restaurant_reviews"], **o)),
    "similarity-edges": (["review_features", "user_anomaly_scores"], {"gap_days": graph.CO_REVIEW_DAYS},
                         lambda t, o: graph.user_similarity_edges(
                             t["review_features"], t["user_anomaly_scores"], o["gap_days"])),
    "user-clusters": (["user_similarity_edges"], {"min_size": communities.MIN_CLUSTER_SIZE, "seed": 42},
                      lambda t, o: communities.user_clusters(communities.louvain_communities(
                          graph.user_graph(t["user_similarity_edges"]), seed=o["seed"]), o["min_size"])),
    "suspicious-businesses": (["review_spikes", "restaurant_reviews", "user_anomaly_scores"], {"window_days": 0},
                              lambda t, o: impact.suspicious_businesses(
                                  spikes.spike_events(t["review_spikes"]), t["restaurant_reviews"],
                                  t["user_anomaly_scores"], o["window_days"])),
    "rating-impact": (["suspicious_businesses", "restaurant_reviews"],
                      {"before_days": 30, "during_days": 0, "after_days": 30},
                      lambda t, o: impact.rating_impact(
                          t["suspicious_businesses"], spikes.daily_totals(t["restaurant_reviews"]), **o)),
    "volume-impact": (["suspicious_businesses", "restaurant_reviews"], {}, lambda t, o: impact.volume_impact(
        t["suspicious_businesses"], spikes.daily_totals(t["restaurant_reviews"]))),
    "cases": (["suspicious_businesses", "restaurants_base"], {"min_users": 1}, lambda t, o: authenticity.with_names(
        authenticity.suspicious_cases(t["suspicious_businesses"], o["min_users"]),
        tables.business_names(t["restaurants_base"]))),
    "case-impact": (["cases", "rating_impact"], {}, lambda t, o: authenticity.with_impact(
        t["cases"], t["rating_impact"], how="left")),
    "business-authenticity": (
        ["restaurants_base", "restaurant_reviews", "cases", "rating_impact", "user_anomaly_scores", "user_clusters"], {},
        lambda t, o: authenticity.business_authenticity(
            t["restaurants_base"], t["restaurant_reviews"], t["cases"], t["rating_impact"],
            t["user_anomaly_scores"], t["user_clusters"])),
    "business-card": (
        ["restaurants_base", "restaurant_reviews", "cases", "user_anomaly_scores", "user_clusters"], {},
        lambda t, o: authenticity.business_card(
            t["restaurants_base"], t["restaurant_reviews"], t["cases"], t["user_anomaly_scores"], t["user_clusters"])),
    "business-impact": (["volume_impact", "rating_impact", "restaurants_base"], {"ids": ""},
                        lambda t, o: authenticity.business_impact(
                            t["volume_impact"], t["rating_impact"], t["restaurants_base"],
                            o["ids"].split(",") if o["ids"] else None)),
    "top-cases": (["cases", "rating_impact"], {"limit": 25}, lambda t, o: authenticity.top_cases(
        t["cases"], t["rating_impact"], o["limit"])),
    "top-users": (["user_anomaly_scores"], {"limit": reports.DEFAULT_LIMIT}, lambda t, o: reports.top_suspicious_users(
        t["user_anomaly_scores"], o["limit"])),
    "top-businesses": (["suspicious_businesses"], {"limit": reports.DEFAULT_LIMIT},
                       lambda t, o: reports.top_suspicious_businesses(t["suspicious_businesses"], o["limit"])),
    "bots": (["user_anomaly_scores"], {"limit": 10}, lambda t, o: reports.anomaly_bots(
        t["user_anomaly_scores"], o["limit"])),
    "bombers": (["user_anomaly_scores"], {"limit": 10, "min_per_day": reports.BOMBER_REVIEWS_PER_DAY},
                lambda t, o: reports.anomaly_bombers(t["user_anomaly_scores"], **o)),
    "volume-increases": (["volume_impact"], {"limit": 5}, lambda t, o: reports.volume_increases(
        t["volume_impact"], o["limit"])),
    "volume-decreases": (["volume_impact"], {"limit": 5}, lambda t, o: reports.volume_decreases(
        t["volume_impact"], o["limit"])),
    "growth-cases": (["volume_impact"], {"limit": 10}, lambda t, o: reports.growth_cases(
        t["volume_impact"], o["limit"])),
    "strong-cases": (["volume_impact", "restaurants_base"], {"limit": 10}, lambda t, o: reports.strong_cases(
        t["volume_impact"], t["restaurants_base"], o["limit"])),
}
BY_YEAR = {"reviews-base", "restaurant-reviews", "review-features"}
# Settings of the spike rule that the whole run takes, with the rule's own defaults.
RULE = STEPS["review-spikes"][1]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="candor", description=__doc__)
    p.add_argument("--master", default=None, help="Spark master; left to the deployment if absent")
    steps = p.add_subparsers(dest="step", required=True)
    raw = steps.add_parser("convert-raw", help="raw JSON lines to Parquet")
    raw.add_argument("--raw_dir", required=True)
    raw.add_argument("--out_dir", required=True)
    raw.add_argument("--prefix", default="", help="text before the data set name in the file names")
    raw.add_argument("--infer", action="store_true", help="infer all types instead of giving declared fields theirs")
    for name, (inputs, options, _) in STEPS.items():
        step = steps.add_parser(name)
        for table in inputs:
            step.add_argument(f"--{table}", required=True)
        step.add_argument("--output", required=True)
        step.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet",
                          help="csv: one header a file, nested columns not possible; json: one JSON-safe record a line")
        for option, default in options.items():
            step.add_argument(f"--{option}", type=type(default), default=default)
    whole = steps.add_parser("analyse", help="everything from converted tables to business scores")
    whole.add_argument("--parquet_dir", required=True)
    whole.add_argument("--out_dir", required=True)
    whole.add_argument("--as_of", default="")
    whole.add_argument("--window_days", type=int, default=0, help="days round a spike in which flagged users count")
    for option, default in RULE.items():
        name = "baseline_days" if option == "window_days" else option
        whole.add_argument(f"--{name}", dest=f"rule_{option}", type=type(default), default=default)
    return p


def run(args: argparse.Namespace, spark) -> None:
    if args.step == "convert-raw":
        tables.convert_raw(spark, args.raw_dir, args.out_dir, args.prefix, declared=not args.infer)
    elif args.step == "analyse":
        review, user, business = (
            tables.read_table(spark, f"{args.parquet_dir}/{n}") for n in ("review", "user", "business"))
        done = analyse(review, user, business, as_of=args.as_of or None, window_days=args.window_days,
                       rule={o: getattr(args, f"rule_{o}") for o in RULE}, out_dir=args.out_dir)
        tables.write_table(done["business_authenticity"], f"{args.out_dir}/business_authenticity.parquet")
    else:
        inputs, options, build = STEPS[args.step]
        given = {name: tables.read_table(spark, getattr(args, name)) for name in inputs}
        result = build(given, {o: getattr(args, o) for o in options})
        if args.format == "csv":
            tables.write_csv(result, args.output)
        elif args.format == "json":
            records.json_records(result).write.mode("overwrite").text(args.output)
        else:
            tables.write_table(result, args.output, "review_year" if args.step in BY_YEAR else None)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("candor", args.master)
    with scratch_scope(spark):
        run(args, spark)


if __name__ == "__main__":
    main()
