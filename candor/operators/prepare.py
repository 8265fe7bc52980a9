"""Cleaning of the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.scalars import finite, lenient_number, wall_clock
from candor.schemas import FEATURE_COLUMNS, SIGNUP_COLUMN, require_columns


def add_review_year(reviews: DataFrame) -> DataFrame:
    """Parse ``date`` and derive ``review_year``; unreadable dates give null in both."""
    return reviews.withColumn("date", wall_clock("date")).withColumn("review_year", F.year("date"))


def restaurants_base(businesses: DataFrame, needle: str = "restaurants") -> DataFrame:
    """Businesses with an id whose categories mention ``needle`` in any case."""
    return businesses.filter(
        F.col("business_id").isNotNull() & F.lower(F.col("categories")).contains(needle.lower()))


def reviews_base(reviews: DataFrame) -> DataFrame:
    """Reviews with an author, a business and some text once outer blanks are gone."""
    return (
        reviews.filter(F.col("user_id").isNotNull() & F.col("business_id").isNotNull())
        .withColumn("text", F.trim("text"))
        .filter(F.length("text") > 0)
    )


def users_base(users: DataFrame) -> DataFrame:
    """Users with an id; the sign-up moment is parsed, unreadable text becomes null."""
    return users.filter(F.col("user_id").isNotNull()).withColumn(SIGNUP_COLUMN, wall_clock(SIGNUP_COLUMN))


def restaurant_reviews(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Reviews of the given businesses.

    A semi join, so a repeated business id cannot multiply reviews. The id list
    is broadcast by Spark when its measured size allows; otherwise adaptive
    execution splits the partition of a business that holds most of the rows.
    """
    return reviews.join(restaurants.select("business_id"), "business_id", "left_semi")


def with_signup(reviews: DataFrame, users: DataFrame) -> DataFrame:
    """Every review with the sign-up moment of its author, null where unknown."""
    return reviews.join(users.select("user_id", SIGNUP_COLUMN), "user_id", "left")


def fill_user_features(features: DataFrame) -> DataFrame:
    """Missing features become zero."""
    return require_columns(features, FEATURE_COLUMNS, "user features").fillna(
        {c: 0 for c in FEATURE_COLUMNS})


def drop_incomplete_users(features: DataFrame) -> DataFrame:
    """Drop users without an account age or a friend count."""
    return features.dropna(subset=["account_age_days", "num_friends"])


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as finite doubles; anything else in them becomes null."""
    return df.withColumns({c: lenient_number(c) for c in columns})


def rating_delta(impact: DataFrame) -> DataFrame:
    """Add ``delta_after_before``, null if either side is null."""
    before: Column = finite("avg_stars_before")
    return impact.withColumn("delta_after_before", finite("avg_stars_after") - before)
