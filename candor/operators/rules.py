"""Rule-based user scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.functions.scalars import int_flag
from candor.operators.prepare import fill_user_features
from candor.schemas import FEATURE_COLUMNS

# Thresholds of the three rules.
LOW_AVG_RATING = 1.5
HIGH_AVG_RATING = 4.5
HIGH_SINGLE_RATING_SHARE = 0.90
BURST_MIN_REVIEWS = 20
BURST_MIN_REVIEWS_PER_DAY = 0.02
BURST_MANY_REVIEWS = 50
LOW_SOCIAL_MAX_FRIENDS = 1
LOW_SOCIAL_MIN_REVIEWS = 10

RULE_FLAGS = ["extreme_rating_flag", "review_burst_flag", "low_friends_flag"]


def rule_based_scores(features: DataFrame) -> DataFrame:
    """Three rule flags per user, the share of rules met, and the combined verdict.

    A user is suspicious when socially isolated and, besides, extreme or bursty.
    """
    stars, count = F.col("avg_stars_given"), F.col("review_count")
    isolated = F.col("num_friends") <= LOW_SOCIAL_MAX_FRIENDS
    one_sided = F.greatest("pct_5_star_reviews", "pct_1_star_reviews") >= HIGH_SINGLE_RATING_SHARE
    fast = (count >= BURST_MIN_REVIEWS) & (F.col("reviews_per_day") >= BURST_MIN_REVIEWS_PER_DAY)
    extreme, burst, low = (F.col(c) for c in RULE_FLAGS)
    return (
        fill_user_features(features).select("user_id", *FEATURE_COLUMNS)
        .withColumns({
            RULE_FLAGS[0]: int_flag((stars <= LOW_AVG_RATING) | (stars >= HIGH_AVG_RATING) | one_sided),
            RULE_FLAGS[1]: int_flag(fast | ((count >= BURST_MANY_REVIEWS) & isolated)),
            RULE_FLAGS[2]: int_flag(isolated & (count >= LOW_SOCIAL_MIN_REVIEWS)),
        })
        .withColumn("flag_count", extreme + burst + low)
        .withColumn("rule_based_score", F.round(F.col("flag_count") / F.lit(len(RULE_FLAGS)), 4))
        .withColumn("is_flagged_suspicious", int_flag((low == 1) & (extreme + burst > 0)))
    )


def rule_flag_counts(scores: DataFrame) -> DataFrame:
    """User counts by score, by verdict, by each rule, and by every rule combination.

    All from one pass: rows are first counted by (rules, verdict, score), at most
    sixteen groups, and the reports are grouping sets over that count.
    """
    report = ["rule_based_score", "is_flagged_suspicious", *RULE_FLAGS]
    base = scores.groupBy(*report).agg(F.count(F.lit(1)).alias("n"))
    sets = [[F.col(c)] for c in report] + [[F.col(c) for c in RULE_FLAGS]]
    name = F.when(F.grouping("rule_based_score") == 0, "score").when(
        F.grouping("is_flagged_suspicious") == 0, "verdict")
    for flag in RULE_FLAGS:
        others = [F.grouping(o) == 1 for o in RULE_FLAGS if o != flag]
        name = name.when((F.grouping(flag) == 0) & others[0] & others[1], flag)
    return base.groupingSets(sets, *[F.col(c) for c in report]).agg(
        name.otherwise("combination").alias("report"), F.sum("n").alias("users"),
    ).select("report", *report, "users")


def top_rule_users(scores: DataFrame, limit: int = 20) -> DataFrame:
    """Flagged users first, then by score and number of reviews."""
    return scores.orderBy(F.desc("is_flagged_suspicious"), F.desc("rule_based_score"),
                          F.desc("review_count"), "user_id").limit(limit)
