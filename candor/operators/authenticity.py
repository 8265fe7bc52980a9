"""Cases, business scores and the tables behind an analyst's views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.scalars import int_flag, lenient_number, two_digits
from candor.operators.prepare import rating_delta
from candor.schemas import BUSINESS_INFO_COLUMNS, EVENT_KEY, UNKNOWN_NAME

# Points of the 0-100 score and its thresholds.
POINTS_SPIKE = 20
POINTS_FLAGGED_USERS = 20
POINTS_CLUSTER = 40
POINTS_RATING_CHANGE = 20
RATING_CHANGE_MIN = 0.3
SUSPICIOUS_FROM = 50


def suspicious_cases(businesses: DataFrame, min_users: int = 1) -> DataFrame:
    """Events with at least ``min_users`` flagged users; unreadable counts are zero."""
    if not 1 <= min_users <= 50:
        raise ValueError("min_users must be between 1 and 50")
    return businesses.filter(F.coalesce(lenient_number("suspicious_user_count"), F.lit(0.0)) >= min_users)


def with_names(cases: DataFrame, names: DataFrame) -> DataFrame:
    """Add the business name. Ids are text on the name side, as in ``business_names``."""
    lookup = names.select(F.col("business_id").alias("_id"), "name")
    return (cases.join(lookup, cases.business_id.cast("string") == F.col("_id"), "left").drop("_id")
            .withColumn("name", F.coalesce("name", F.lit(UNKNOWN_NAME))))


def with_impact(cases: DataFrame, impact: DataFrame, how: str = "inner", suffix: str = "_impact") -> DataFrame:
    """Join cases to their rating impact; columns both sides have get ``suffix`` on the right."""
    clash = set(cases.columns) - set(EVENT_KEY)
    right = rating_delta(impact)
    right = right.select(*[F.col(c).alias(c + suffix) if c in clash else F.col(c) for c in right.columns])
    return cases.join(right, EVENT_KEY, how)


def top_cases(cases: DataFrame, impact: DataFrame, limit: int = 25) -> DataFrame:
    """Most flagged users first, then the largest rise in rating."""
    return with_impact(cases, impact).orderBy(
        F.desc_nulls_last("suspicious_user_count"), F.desc_nulls_last("delta_after_before"), *EVENT_KEY,
    ).select(
        "name", *EVENT_KEY, "suspicious_user_count", "suspicious_reviews_in_window", "review_count",
        "delta_after_before", "avg_stars_before", "avg_stars_during", "avg_stars_after",
    ).limit(limit)


def case_labels(cases: DataFrame, impact: DataFrame) -> DataFrame:
    """Pick-list text of every case with known impact."""
    delta = F.when(F.col("delta_after_before").isNull(), "nan").otherwise(two_digits("delta_after_before"))
    parts = [F.trim("name"), F.col("business_id").cast("string"), F.col("spike_date").cast("string"),
             F.concat(F.lit("susp_users="), F.col("suspicious_user_count").cast("string")),
             F.concat(F.lit("Δ="), delta)]
    return with_impact(cases, impact).select(*EVENT_KEY, F.concat_ws(" | ", *parts).alias("label"))


def business_labels(cases: DataFrame) -> DataFrame:
    """``name · id`` of every business that has a case."""
    label = F.concat_ws(" · ", "name", F.col("business_id").cast("string"))
    return cases.select("business_id", "name").distinct().select("business_id", label.alias("label"))


def distinct_names(names: DataFrame) -> DataFrame:
    return names.select("name").distinct().orderBy("name")


def business_spike_events(cases: DataFrame) -> DataFrame:
    """Events of each business in date order."""
    return cases.select(
        *EVENT_KEY, "review_count", "baseline_mean", "abs_increase", "total_reviews_in_window",
        "suspicious_reviews_in_window", "suspicious_user_count", "max_anomaly_score",
    ).orderBy(*EVENT_KEY)


def flagged_reviewers(reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """Distinct flagged users who reviewed each business.

    The few flagged users select the reviews first; what is left collapses
    map-side to distinct pairs.
    """
    flagged = scores.filter(F.col("is_anomaly") == 1).select("user_id")
    return reviews.select("business_id", "user_id").join(flagged, "user_id", "left_semi").distinct()


def business_authenticity(restaurants: DataFrame, reviews: DataFrame, cases: DataFrame, impact: DataFrame,
                          scores: DataFrame, clusters: DataFrame) -> DataFrame:
    """Score 0-100 of every business: has a case, flagged users in it, a reviewer in a
    cluster, a rating change above 0.3. Suspicious from 50."""
    per_case = cases.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("n_cases"), F.sum("suspicious_user_count").alias("flagged"))
    clustered = (
        flagged_reviewers(reviews, scores)
        .join(clusters.select("user_id"), "user_id", "left_semi")
        .groupBy("business_id").agg(F.count(F.lit(1)).alias("n_clustered"))
    )
    change = rating_delta(impact).groupBy("business_id").agg(
        F.max(F.abs("delta_after_before")).alias("max_abs_delta"))
    checks = {
        "has_spike_case": (F.col("n_cases") > 0, POINTS_SPIKE),
        "has_flagged_users": (F.col("flagged") > 0, POINTS_FLAGGED_USERS),
        "has_cluster": (F.col("n_clustered") > 0, POINTS_CLUSTER),
        "has_rating_change": (F.col("max_abs_delta") > RATING_CHANGE_MIN, POINTS_RATING_CHANGE),
    }
    joined = restaurants.select("business_id").distinct()
    for side in (per_case, clustered, change):
        joined = joined.join(side, "business_id", "left")
    flags = joined.select("business_id", *[int_flag(c).alias(name) for name, (c, _) in checks.items()])
    score: Column = sum((F.col(name) * points for name, (_, points) in checks.items()), F.lit(0))
    return flags.withColumn("authenticity_score", score).withColumn(
        "is_suspicious", int_flag(F.col("authenticity_score") >= SUSPICIOUS_FROM))


def business_card(restaurants: DataFrame, reviews: DataFrame, cases: DataFrame, scores: DataFrame,
                  clusters: DataFrame) -> DataFrame:
    """Case spikes, flagged users over them, and distinct clusters per business."""
    per_case = cases.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("review_spikes"), F.sum("suspicious_user_count").alias("suspicious_users"))
    met = (flagged_reviewers(reviews, scores).join(clusters.select("user_id", "cluster_id"), "user_id")
           .groupBy("business_id").agg(F.countDistinct("cluster_id").alias("review_farm_clusters")))
    return (
        restaurants.select("business_id").distinct()
        .join(per_case, "business_id", "left").join(met, "business_id", "left")
        .fillna({"review_spikes": 0, "suspicious_users": 0, "review_farm_clusters": 0})
    )


def max_delta_event(impact: DataFrame) -> DataFrame:
    """Per business the event with the largest absolute rating change, else its first event."""
    row = rating_delta(impact)
    rank = F.struct((-F.abs("delta_after_before")).isNull(), -F.abs("delta_after_before"), "spike_date")
    picked = [c for c in ("spike_date", "avg_stars_before", "avg_stars_during", "avg_stars_after",
                          "delta_after_before") if c in row.columns]
    return (row.groupBy("business_id").agg(F.min_by(F.struct(*picked), rank).alias("_event"))
            .select("business_id", *[f"_event.{c}" for c in picked]))


def impact_by_period(impact: DataFrame) -> DataFrame:
    """One row per event and period with its mean stars."""
    periods = [F.struct(F.lit(p.capitalize()).alias("period"), F.col(f"avg_stars_{p}").alias("avg_stars"))
               for p in ("before", "during", "after")]
    return (impact.select(*EVENT_KEY, F.explode(F.array(*periods)).alias("_p"))
            .select(*EVENT_KEY, "_p.period", "_p.avg_stars"))


def users_vs_delta(cases: DataFrame, impact: DataFrame) -> DataFrame:
    """Flagged users against rating change, one row per case with a known change."""
    known = rating_delta(impact).dropna(subset=["delta_after_before"]).select(*EVENT_KEY, "delta_after_before")
    return cases.join(known, EVENT_KEY).select(
        *EVENT_KEY, "name", "suspicious_user_count", "suspicious_reviews_in_window", "delta_after_before")


def enrich_business(rows: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Attach ``business`` = {name, city, state, categories}; null where unknown.

    Of repeated ids the smallest record is kept.
    """
    info = restaurants.groupBy("business_id").agg(F.min(F.struct(*BUSINESS_INFO_COLUMNS)).alias("business"))
    return rows.join(info, "business_id", "left")


def _with_ids(rows: DataFrame, ids: list) -> DataFrame:
    """Rows of the wanted businesses; ids take the column's type, so that the scan itself can choose. Others match nothing."""
    kind = rows.schema["business_id"].dataType
    wanted = [F.lit(str(i)).try_cast(kind) for i in ids]
    return rows.filter(F.col("business_id").isin(wanted))


def business_impact(volume: DataFrame, rating: DataFrame, restaurants: DataFrame | None = None,
                    ids: list | None = None) -> DataFrame:
    """Volume and rating impact side by side for every event known to either.

    ``ids`` looks up single businesses: the choice is pushed to both scans, and
    if neither side knows any of them a ``LookupError`` is raised.
    """
    if ids is not None:
        volume, rating = _with_ids(volume, ids), _with_ids(rating, ids)
        if volume.isEmpty() and rating.isEmpty():
            raise LookupError(f"no impact is known for {ids}")
    right = rating_delta(rating).withColumnRenamed("delta_after_before", "rating_change")
    clash = set(volume.columns) & set(right.columns) - set(EVENT_KEY)
    right = right.select(*[F.col(c).alias(c + "_rating") if c in clash else F.col(c) for c in right.columns])
    both = volume.join(right, EVENT_KEY, "full_outer")
    return enrich_business(both, restaurants) if restaurants is not None else both
