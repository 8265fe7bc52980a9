"""Behavioural features per review and per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.functions.ranking import sequence_within
from candor.functions.scalars import friend_count, ratio
from candor.operators.prepare import with_signup
from candor.schemas import FEATURE_COLUMNS, SIGNUP_COLUMN
from candor.session import stored


def user_review_sequence(reviews: DataFrame, hot_rows: int = 5_000_000) -> DataFrame:
    """Number each user's reviews 1..N by date, then review id."""
    order = [F.col("date").asc_nulls_last(), F.col("review_id").asc_nulls_last()]
    return sequence_within(reviews, "user_id", order, "user_review_sequence", hot_rows)


def review_features(reviews: DataFrame, users: DataFrame, hot_rows: int = 5_000_000) -> DataFrame:
    """Length, hour, weekday (Sunday = 1), days since sign-up and sequence of every review.

    Text is reduced to its length before anything is shuffled, and the narrow
    rows are stored, since they are counted by user before they are numbered.
    """
    narrow = stored(reviews.select(
        "review_id", "business_id", "user_id", "date", "review_year", "stars",
        F.length("text").alias("review_length"),
        F.hour("date").alias("review_hour"),
        F.dayofweek("date").alias("day_of_week"),
    ), "narrow-reviews")
    numbered = user_review_sequence(narrow, hot_rows)
    return with_signup(numbered, users).select(
        "review_id", "business_id", "user_id", "date", "review_year", "stars",
        "review_length", "review_hour", "day_of_week",
        F.date_diff(F.to_date("date"), F.to_date(SIGNUP_COLUMN)).alias("days_since_signup"),
        "user_review_sequence",
    )


def user_review_stats(reviews: DataFrame) -> DataFrame:
    """Mean stars, shares of fives and ones, and number of rated reviews per user."""
    rated = reviews.select("user_id", "stars").filter(
        F.col("user_id").isNotNull() & F.col("stars").isNotNull())
    total = F.count(F.lit(1))
    return rated.groupBy("user_id").agg(
        F.avg("stars").alias("avg_stars_given"),
        (F.count_if(F.col("stars") == 5) / total).alias("pct_5_star_reviews"),
        (F.count_if(F.col("stars") == 1) / total).alias("pct_1_star_reviews"),
        total.alias("review_count"),
    )


def user_profile(users: DataFrame, as_of: str | None = None) -> DataFrame:
    """Account age in days on ``as_of`` (today if absent) and number of friends."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return users.select(
        "user_id",
        F.date_diff(day, F.to_date(SIGNUP_COLUMN)).alias("account_age_days"),
        friend_count(users).alias("num_friends"),
    )


def user_features(reviews: DataFrame, users: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per reviewing user with the seven model features.

    Reviews collapse to one row per user before they meet the user table.
    """
    per_day = F.coalesce(ratio("review_count", "account_age_days"), F.lit(0.0))
    return (
        user_review_stats(reviews).join(user_profile(users, as_of), "user_id", "left")
        .withColumn("reviews_per_day", per_day)
        .select("user_id", *FEATURE_COLUMNS)
    )
