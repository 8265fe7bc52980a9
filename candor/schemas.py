"""Declared schemas, fixed values of the data model, and the input contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names and thresholds the results depend on.
SIGNUP_COLUMN = "yelping_since"
FEATURE_COLUMNS = [
    "avg_stars_given",
    "pct_5_star_reviews",
    "pct_1_star_reviews",
    "review_count",
    "reviews_per_day",
    "account_age_days",
    "num_friends",
]
RAW_DATASETS = ["business", "user", "checkin", "tip", "review"]
BUSINESS_INFO_COLUMNS = ["name", "city", "state", "categories"]
UNKNOWN_NAME = "(unknown name)"
EVENT_KEY = ["business_id", "spike_date"]

# Raw JSON lines. The date-like fields are text there and are parsed by
# candor.operators.prepare; only the columns the engine uses are declared.
RAW_SCHEMAS = {
    "business": T.StructType([
        T.StructField("business_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("categories", T.StringType()),
    ]),
    "user": T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField(SIGNUP_COLUMN, T.StringType()),
        T.StructField("friends", T.StringType()),
    ]),
    "review": T.StructType([
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("date", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "checkin": T.StructType([
        T.StructField("business_id", T.StringType()),
        T.StructField("date", T.StringType()),
    ]),
    "tip": T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("compliment_count", T.LongType()),
    ]),
}


def require_columns(df: DataFrame, needed, what: str = "input") -> DataFrame:
    """Return ``df``, or raise listing the columns it lacks. Looks at the schema only."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns {missing}; it has {sorted(df.columns)}")
    return df
