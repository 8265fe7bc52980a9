from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from candor.functions.scalars import friend_count, lenient_number, two_digits
from candor.operators import features, forest, prepare, records, rules
from candor.schemas import FEATURE_COLUMNS, SIGNUP_COLUMN


def test_friend_count_of_text_and_arrays(spark):
    text = spark.createDataFrame([(None,), ("",), ("  ",), ("None",), ("NONE ",), ("a",), ("a, b ,c",)],
                                 "friends string")
    assert [r[0] for r in text.select(friend_count(text)).collect()] == [0, 0, 0, 0, 0, 1, 3]
    array = spark.createDataFrame([(None,), ([],), (["a", "b"],)], "friends array<string>")
    assert [r[0] for r in array.select(friend_count(array)).collect()] == [0, 0, 2]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",), ("Infinity",), ("-Infinity",)], "v string")
    assert [r[0] for r in df.select(lenient_number("v")).collect()] == [1.5, None, None, None, None, None]


def test_two_digits_as_text(spark):
    values = [0.125, -0.125, 0.375, 2.0, -0.001, 0.001, 1.6666, -3.14159, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(two_digits("v")).collect()] == [f"{v:.2f}" for v in values]


def _users(spark, rows):
    schema = T.StructType([T.StructField("user_id", T.LongType())] + [
        T.StructField(c, T.LongType() if c in ("review_count", "account_age_days", "num_friends") else T.DoubleType())
        for c in FEATURE_COLUMNS])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("row, extreme, burst, low, suspicious", [
    ((4.4, 0.90, 0.0, 5, 0.001, 100, 5), 1, 0, 0, 0),
    ((4.4, 0.89, 0.0, 5, 0.001, 100, 5), 0, 0, 0, 0),
    ((1.5, 0.0, 0.0, 10, 0.001, 100, 1), 1, 0, 1, 1),
    ((1.51, 0.0, 0.0, 10, 0.001, 100, 1), 0, 0, 1, 0),
    ((3.0, 0.0, 0.0, 20, 0.02, 100, 9), 0, 1, 0, 0),
    ((3.0, 0.0, 0.0, 19, 0.02, 100, 1), 0, 0, 1, 0),
    ((3.0, 0.0, 0.0, 50, 0.001, 100, 1), 0, 1, 1, 1),
    ((3.0, 0.0, 0.0, 50, 0.001, 100, 2), 0, 0, 0, 0),
    ((None, None, None, None, None, None, None), 1, 0, 0, 0),
])
def test_rules(spark, row, extreme, burst, low, suspicious):
    got = rules.rule_based_scores(_users(spark, [(1, *row)])).first()
    assert [got[c] for c in rules.RULE_FLAGS] == [extreme, burst, low]
    assert got["is_flagged_suspicious"] == suspicious
    assert got["rule_based_score"] == round((extreme + burst + low) / 3, 4)


def test_missing_age_gives_rate_zero(spark):
    reviews = spark.createDataFrame([(1, 5.0), (1, 1.0), (2, 5.0), (3, None), (None, 2.0)], "user_id long, stars double")
    users = spark.createDataFrame([(1, dt.datetime(2001, 12, 30), "a")],
                                  f"user_id long, {SIGNUP_COLUMN} timestamp_ntz, friends string")
    got = {r["user_id"]: r for r in features.user_features(reviews, users, "2002-01-01").collect()}
    assert set(got) == {1, 2}
    assert (got[1]["account_age_days"], got[1]["reviews_per_day"], got[1]["pct_5_star_reviews"]) == (2, 1.0, 0.5)
    assert (got[2]["account_age_days"], got[2]["num_friends"], got[2]["reviews_per_day"]) == (None, None, 0.0)


def test_sequence_is_the_same_for_hot_keys(spark):
    rows = [(f"r{i:04d}", (None if i % 7 == 0 else (1 if i % 3 else 2 + i % 11)),
             dt.datetime(2020, 1, 1) + dt.timedelta(hours=(i * 37) % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id string, user_id long, date timestamp_ntz").repartition(7)
    plain = features.user_review_sequence(df)
    split = features.user_review_sequence(df, hot_rows=30)
    assert plain.count() == 400
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_review_features_sunday_is_one(spark):
    reviews = spark.createDataFrame(
        [("r", "b", 1, dt.datetime(2024, 3, 3, 21, 5), 2024, 4.0, "héllo")],
        "review_id string, business_id string, user_id long, date timestamp_ntz, review_year int, stars double, text string")
    users = spark.createDataFrame([(1, dt.datetime(2024, 3, 10))], f"user_id long, {SIGNUP_COLUMN} timestamp_ntz")
    r = features.review_features(reviews, users).first()
    assert (r["day_of_week"], r["review_hour"], r["review_length"], r["days_since_signup"]) == (1, 21, 5, -7)


def test_unreadable_dates_become_null(spark):
    df = spark.createDataFrame([("2020-02-03 04:05:06",), ("nonsense",), (None,)], "date string")
    assert [r["review_year"] for r in prepare.add_review_year(df).collect()] == [2020, None, None]


def test_repeated_restaurant_does_not_multiply_reviews(spark):
    reviews = spark.createDataFrame([(1, "b")], "x int, business_id string")
    twice = spark.createDataFrame([("b",), ("b",)], "business_id string")
    assert prepare.restaurant_reviews(reviews, twice).count() == 1


def test_median_impute_and_all_null_column(spark):
    df = _users(spark, [(i, float(i), None, 0.5, i, 0.1, 10, 1) for i in range(1, 5)]
                + [(9, None, None, 0.5, None, float("inf"), 10, 1)])
    got = {r["user_id"]: r for r in forest.median_impute(df).collect()}
    assert got[9]["avg_stars_given"] == 2.5 and got[9]["review_count"] == 2.5
    assert got[9]["reviews_per_day"] == 0.1
    assert all(r["pct_5_star_reviews"] == 0.0 for r in got.values())


def test_json_records(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3), float("nan"), float("inf"), 1.5, None, 3)],
        "d date, t timestamp_ntz, n double, i double, x double, s string, k int")
    text = records.json_records(df).first()[0]
    assert text == '{"d":"2020-01-02","t":"2020-01-02","n":null,"i":null,"x":1.5,"s":null,"k":3}'
