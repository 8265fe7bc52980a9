"""The review data model as views over the supplied star-schema tables.

The mapping is the one of FIXTURES.md. The modulo expressions plant the
irregular values the operators must cope with (missing ids, blank texts,
unreadable dates, reviewers without metadata); every view derives from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.schemas import SIGNUP_COLUMN

AS_OF = "2002-01-01"
# Spike rule that finds events at the density of these tables.
TUNED_RULE = {"window_days": 30, "min_history_days": 30, "min_reviews": 4,
              "ratio_threshold": 2.0, "abs_increase_threshold": 3.0}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as reviews: supplier group = business, customer = author."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(
        "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
        " date_format(l_shipdate, 'yyyy-MM-dd'))) AS review_id",
        "CASE WHEN l_orderkey % 101 <> 0 THEN if(o_custkey % 97 = 5, -o_custkey, o_custkey) END AS user_id",
        "CASE WHEN l_orderkey % 103 <> 0 THEN l_suppkey div 5 END AS business_id",
        "CASE WHEN o_custkey % 10 = 0 THEN 5D WHEN o_custkey % 10 = 1 THEN 1D"
        " ELSE CAST(1 + CAST(l_quantity AS INT) % 5 AS DOUBLE) END AS stars",
        "CASE WHEN l_partkey % 50 = 0 THEN '   '"
        " ELSE concat('  ', repeat(l_returnflag, CAST(l_quantity AS INT)), ' ') END AS text",
        "timestampadd(HOUR, 3 * l_linenumber, l_shipdate) AS date",
    ).withColumn("review_year", F.year("date"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as raw JSON has them: the date is text."""
    return (reviews(spark, sf_dir).drop("review_year")
            .withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as users; reviewers with a negative id have no row here, some dates are unreadable."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 211 = 0 THEN 'bad' ELSE date_format("
        "timestampadd(DAY, CAST(c_custkey % 1500 AS INT), TIMESTAMP_NTZ '1990-01-01 00:00:00'),"
        f" 'yyyy-MM-dd HH:mm:ss') END AS {SIGNUP_COLUMN}",
        "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None'"
        " ELSE concat(repeat('f, ', CAST(c_custkey % 9 AS INT)), 'f') END AS friends",
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem").selectExpr("l_suppkey div 5 AS business_id").distinct()
        .selectExpr(
            "business_id",
            "concat('Business ', business_id div 2) AS name",
            "concat('City ', business_id % 3) AS city",
            "concat('S', business_id % 3) AS state",
            "CASE WHEN business_id % 8 = 7 THEN NULL ELSE CASE business_id % 4"
            " WHEN 0 THEN 'Mexican, Restaurants' WHEN 1 THEN 'restaurants, Bars'"
            " WHEN 2 THEN 'RESTAURANTS' ELSE 'Shopping' END END AS categories",
        )
    )


def user_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in scores with exact values, so that everything after them has an exact oracle."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END AS is_anomaly",
        "(c_custkey % 97) / 1000D AS anomaly_score",
    )


def user_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in clusters of the flagged users."""
    return (user_flags(spark, sf_dir).filter("is_anomaly = 1")
            .selectExpr("user_id", "user_id % 7 AS cluster_id"))
