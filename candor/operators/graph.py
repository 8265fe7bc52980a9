"""Co-review graph of flagged users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.functions.scalars import wall_micros
from candor.session import stored

# Co-review gap in days, strict.
CO_REVIEW_DAYS = 7
MICROS_PER_DAY = 86_400_000_000


def co_review_pairs(reviews: DataFrame, gap_days: int = CO_REVIEW_DAYS, cell_rows: int = 4_000) -> DataFrame:
    """Every pair of reviews of one business less than ``gap_days`` apart, once.

    Time is cut into spans of ``gap_days``; the earlier review of a pair enters
    its own span and the next, the later one only its own, so a pair meets in
    exactly one (business, span). A span with more than ``cell_rows`` rows is
    laid out as a square of cells: the earlier reviews are hashed to rows of
    the square and the later ones to columns, each copied along its line. A
    cell holds about ``cell_rows`` reviews of either side, whatever the size of
    the business, and every pair falls into exactly one cell.

    ``reviews`` is read three times, so pass a stored table.
    """
    span = gap_days * MICROS_PER_DAY
    base = reviews.select("review_id", "user_id", "business_id", wall_micros("date").alias("at"))
    own = F.floor(F.col("at") / span)
    early = base.withColumn("span", F.explode(F.array(own, own + 1)))
    late = base.withColumn("span", own)

    sizes = early.groupBy("business_id", "span").agg(F.count(F.lit(1)).alias("_rows"))
    # Only spans over the limit are listed: at most 2 N / cell_rows rows. As a
    # stored table it has a true size, by which Spark decides on broadcasting it.
    crowded = stored(sizes.filter(F.col("_rows") > cell_rows).select(
        "business_id", "span", F.ceil(F.col("_rows") / cell_rows).cast("int").alias("_side")), "crowded")
    any_crowded = not crowded.isEmpty()

    def celled(side: DataFrame, mine: str, other: str) -> DataFrame:
        if not any_crowded:
            return side.withColumns({mine: F.lit(0), other: F.lit(0)})
        n = F.coalesce(F.col("_side"), F.lit(1))
        return (
            side.join(crowded, ["business_id", "span"], "left")
            .withColumn(mine, F.pmod(F.xxhash64("review_id"), n).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), n - 1)))
            .drop("_side")
        )

    a = celled(early, "_row", "_column").select(
        "business_id", "span", "_row", "_column", F.col("review_id").alias("review_1"),
        F.col("user_id").alias("user_1"), F.col("at").alias("at_1"))
    b = celled(late, "_column", "_row").select(
        "business_id", "span", "_row", "_column", F.col("review_id").alias("review_2"),
        F.col("user_id").alias("user_2"), F.col("at").alias("at_2"))
    earlier = (F.col("at_1") < F.col("at_2")) | (
        (F.col("at_1") == F.col("at_2")) & (F.col("review_1") < F.col("review_2")))
    gap = F.col("at_2") - F.col("at_1")
    in_order = F.col("review_1") < F.col("review_2")

    def first(x: str, y: str):
        return F.when(in_order, F.col(x)).otherwise(F.col(y))

    return (
        a.join(b, ["business_id", "span", "_row", "_column"]).filter(earlier & (gap < span))
        .select(
            first("review_1", "review_2").alias("review_id_a"),
            first("review_2", "review_1").alias("review_id_b"),
            first("user_1", "user_2").alias("user_id_a"),
            first("user_2", "user_1").alias("user_id_b"),
            "business_id",
            F.floor(gap / MICROS_PER_DAY).cast("int").alias("time_diff_days"),
        )
    )


def flagged_reviews(reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """Reviews by flagged users. Filtered before any pair is formed."""
    flagged = scores.filter(F.col("is_anomaly") == 1).select("user_id")
    return reviews.select("review_id", "user_id", "business_id", "date").join(flagged, "user_id", "left_semi")


def user_similarity_edges(reviews: DataFrame, scores: DataFrame, gap_days: int = CO_REVIEW_DAYS,
                          cell_rows: int = 4_000) -> DataFrame:
    """One row per co-review of flagged users; a user with two close reviews gives a self-edge."""
    flagged = stored(flagged_reviews(reviews, scores), "flagged-reviews")
    pairs = co_review_pairs(flagged, gap_days, cell_rows)
    return pairs.select("user_id_a", "user_id_b", "business_id", "time_diff_days")


def user_graph(edges: DataFrame) -> DataFrame:
    """Undirected simple graph with the number of shared businesses as weight.

    Repeated co-reviews collapse map-side to one row per pair and business
    before the shuffle.
    """
    pair = edges.select(F.least("user_id_a", "user_id_b").alias("user_a"),
                        F.greatest("user_id_a", "user_id_b").alias("user_b"), "business_id")
    return pair.groupBy("user_a", "user_b").agg(F.countDistinct("business_id").alias("weight"))


def co_reviewer_graph(reviews: DataFrame, gap_days: int = CO_REVIEW_DAYS) -> DataFrame:
    """The graph of ``user_graph`` without a list of review pairs; ``reviews`` are those of flagged users.

    Reviews collapse map-side to one row per business, span of ``gap_days`` and
    user, with the first and the last time and a count. Two users in one span
    always co-review; in neighbouring spans they do when the later one's first
    review follows the earlier one's last by less than the gap. A user is linked
    to itself by two such reviews. So the work grows with users, however many
    reviews each of them has.
    """
    span = gap_days * MICROS_PER_DAY
    at = wall_micros("date")
    stays = stored(
        reviews.select("business_id", "user_id", F.floor(at / span).alias("span"), at.alias("at"))
        .groupBy("business_id", "span", "user_id")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")), "stays")
    late = stays.select("business_id", "span", F.col("user_id").alias("user_2"), F.col("first").alias("first_2"))
    same = (stays.join(late, ["business_id", "span"])
            .filter("user_id < user_2 OR (user_id = user_2 AND n > 1)"))
    following = (stays.withColumn("span", F.col("span") + 1).join(late, ["business_id", "span"])
                 .filter(F.col("first_2") - F.col("last") < span))
    met = same.select("business_id", "user_id", "user_2").union(following.select("business_id", "user_id", "user_2"))
    return (met.groupBy(F.least("user_id", "user_2").alias("user_a"), F.greatest("user_id", "user_2").alias("user_b"))
            .agg(F.countDistinct("business_id").alias("weight")))
