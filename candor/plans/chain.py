"""The whole run, from base tables to business scores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candor.operators import authenticity, communities, features, forest, graph, impact, prepare, rules, spikes
from candor.session import stored
from candor.sources import tables


def analyse(raw_reviews: DataFrame, raw_users: DataFrame, raw_businesses: DataFrame,
            as_of: str | None = None, rule: dict | None = None, window_days: int = 0,
            out_dir: str | None = None) -> dict[str, DataFrame]:
    """Every result table by name.

    Tables with several readers are written, to ``out_dir/<name>.parquet`` or
    to scratch, so that no step repeats another's work. ``raw_reviews`` needs a
    parsed ``date`` and its ``review_year``.
    """
    done: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        done[name] = stored(df, name, f"{out_dir}/{name}.parquet" if out_dir else None)
        return done[name]

    restaurants = keep("restaurants_base", prepare.restaurants_base(raw_businesses))
    users = keep("users_base", prepare.users_base(raw_users))
    reviews = keep("restaurant_reviews",
                   prepare.restaurant_reviews(prepare.reviews_base(raw_reviews), restaurants))
    keep("review_features", features.review_features(reviews, users))
    profile = keep("user_features", features.user_features(reviews, users, as_of))
    keep("rule_based_scores", rules.rule_based_scores(profile))
    scores = keep("user_anomaly_scores", forest.user_anomaly_scores(profile))

    found = keep("review_spikes", spikes.review_spikes(reviews, **(rule or {})))
    events = spikes.spike_events(found)
    daily = keep("daily_totals", spikes.daily_totals(reviews))
    suspicious = keep("suspicious_businesses",
                      impact.suspicious_businesses(events, reviews, scores, window_days))
    rating = keep("rating_impact", impact.rating_impact(suspicious, daily))
    keep("volume_impact", impact.volume_impact(suspicious, daily))

    if out_dir:  # the list of review pairs is a result of its own; the graph does not need it
        keep("user_similarity_edges", graph.user_similarity_edges(reviews, scores))
    members = communities.louvain_communities(graph.co_reviewer_graph(graph.flagged_reviews(reviews, scores)))
    clusters = keep("user_clusters", communities.user_clusters(members))

    cases = keep("cases", authenticity.with_names(
        authenticity.suspicious_cases(suspicious), tables.business_names(restaurants)))
    done["business_authenticity"] = authenticity.business_authenticity(
        restaurants, reviews, cases, rating, scores, clusters)
    return done
