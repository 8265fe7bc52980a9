"""What happened around each spike event: flagged activity, ratings, volume.

Where single reviews or days are wanted, an event's window is opened up into its
days and met by an equi-join on (business, day). That key spreads a dominant
business over all its days, where a join on the business with a range condition
would put it into one task. Where only totals of a period are wanted, they are
differences of running totals: two points an event and period, whatever the
period's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.functions.scalars import int_flag, ratio
from candor.schemas import EVENT_KEY, require_columns

# Window of the volume comparison and what counts as meaningful.
VOLUME_WINDOW_DAYS = 30
MEANINGFUL_INCREASE = 10
MEANINGFUL_PCT_CHANGE = 25

_ZERO_FILLED = {"total_reviews_in_window": 0, "suspicious_reviews_in_window": 0, "suspicious_user_count": 0}


def event_days(events: DataFrame, before: int, after: int) -> DataFrame:
    """One row per event and day of its window [-before, +after]."""
    day = F.col("spike_date")
    return events.select(
        *EVENT_KEY,
        F.explode(F.sequence(F.date_add(day, -before), F.date_add(day, after))).alias("review_date"),
    )


def spike_window_reviews(reviews: DataFrame, events: DataFrame, window_days: int = 0) -> DataFrame:
    """Interval join: every review within ``window_days`` of a spike of its business."""
    if window_days < 0:
        raise ValueError("window_days must be >= 0")
    dated = reviews.withColumn("review_date", F.to_date("date"))
    return dated.join(event_days(events, window_days, window_days), ["business_id", "review_date"])


def anomalous_users(scores: DataFrame) -> DataFrame:
    """Flagged users with their score."""
    require_columns(scores, ["user_id", "is_anomaly", "anomaly_score"], "user scores")
    return scores.filter(F.col("is_anomaly") == 1).select(
        "user_id", F.col("anomaly_score").cast("double").alias("anomaly_score"))


def suspicious_window_reviews(reviews: DataFrame, events: DataFrame, scores: DataFrame,
                              window_days: int = 0) -> DataFrame:
    """The window reviews written by flagged users, with their score."""
    window = spike_window_reviews(
        reviews.select("review_id", "business_id", "user_id", "date"), events, window_days)
    return window.join(anomalous_users(scores), "user_id").select(
        *EVENT_KEY, "review_id", "user_id", "review_date", "anomaly_score")


def window_activity(reviews: DataFrame, events: DataFrame, scores: DataFrame,
                    window_days: int = 0) -> DataFrame:
    """Per event: all reviews, flagged reviews, flagged users, top and mean flagged score.

    Window reviews first collapse to one row per event and author, so a
    prolific author has one row per event when joined to the scores, and
    distinct users are then a plain count.
    """
    window = spike_window_reviews(reviews.select("business_id", "user_id", "date"), events, window_days)
    authors = window.groupBy(*EVENT_KEY, "user_id").agg(F.count(F.lit(1)).alias("n"))
    known = authors.join(anomalous_users(scores), "user_id", "left")
    flagged_rows = F.sum(F.when(F.col("anomaly_score").isNotNull(), F.col("n")))
    return known.groupBy(*EVENT_KEY).agg(
        F.sum("n").alias("total_reviews_in_window"),
        F.coalesce(flagged_rows, F.lit(0)).alias("suspicious_reviews_in_window"),
        F.count("anomaly_score").alias("suspicious_user_count"),
        F.max("anomaly_score").alias("max_anomaly_score"),
        (F.sum(F.col("anomaly_score") * F.col("n")) / flagged_rows).alias("avg_anomaly_score"),
    )


def suspicious_window_aggs(reviews: DataFrame, events: DataFrame, scores: DataFrame,
                           window_days: int = 0) -> DataFrame:
    """Flagged activity of the events that have any."""
    return (window_activity(reviews, events, scores, window_days)
            .filter(F.col("suspicious_user_count") > 0).drop("total_reviews_in_window"))


def suspicious_businesses(events: DataFrame, reviews: DataFrame, scores: DataFrame,
                          window_days: int = 0) -> DataFrame:
    """Every spike event with its activity; counts are zero and scores null where there is none."""
    activity = window_activity(reviews, events, scores, window_days)
    return (
        events.join(activity, EVENT_KEY, "left").fillna(_ZERO_FILLED)
        .withColumn("window_days", F.lit(window_days))
    )


def period_totals(daily: DataFrame, events: DataFrame, periods: dict[str, tuple[int, int]],
                  measures: list[str]) -> DataFrame:
    """Per event: the sum of each daily measure over each period, as ``{measure}_{period}``.

    ``periods`` maps a name to its first and last day relative to the event, both
    included; ``daily`` has at most one row per business and day. The points at
    which periods end join the days of their business, in order of date, and
    read the running totals there. A business thus has one row per active day
    and a few per event in its window, and one exchange by business serves the
    running totals and the events' sums. Sums are zero where a period has no
    days; rows without business or event day have no periods. Differences of
    running totals are exact for whole and half numbers.
    """
    known = events.select(*EVENT_KEY).filter(F.col("business_id").isNotNull() & F.col("spike_date").isNotNull())
    offsets = sorted({o for first, last in periods.values() for o in (first - 1, last)})
    points = known.select(*EVENT_KEY, F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_offset")).select(
        "business_id", F.date_add("spike_date", F.col("_offset")).alias("_day"), "spike_date", "_offset",
        *[F.lit(None).cast(daily.schema[m].dataType).alias(m) for m in measures])
    days = daily.join(known.select("business_id").distinct(), "business_id", "left_semi").select(
        "business_id", F.col("review_date").alias("_day"), F.lit(None).cast("date").alias("spike_date"),
        F.lit(None).cast("int").alias("_offset"), *measures)
    # A point counts its own day: days come before the points of the same date.
    upto = (Window.partitionBy("business_id").orderBy("_day", F.col("_offset").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = days.unionByName(points).select(
        *EVENT_KEY, "_offset", *[F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(m) for m in measures])

    def total(measure: str, first: int, last: int) -> Column:
        at = F.col("_offset")
        return (F.sum(F.when(at == last, F.col(measure)).otherwise(0))
                - F.sum(F.when(at == first - 1, F.col(measure)).otherwise(0)))

    return running.filter(F.col("_offset").isNotNull()).groupBy(*EVENT_KEY).agg(*[
        total(m, *span).alias(f"{m}_{name}") for name, span in periods.items() for m in measures])


def rating_periods(daily: DataFrame, events: DataFrame, before_days: int = 30, during_days: int = 0,
                   after_days: int = 30) -> DataFrame:
    """Mean stars and rated reviews before, during and after each event, from one set of running totals.

    ``daily`` is ``spikes.daily_totals``. A period without rated reviews has
    null for both the mean and the count, an event with none at all is absent.
    Periods may overlap when ``during_days`` is positive. A day whose sum is NaN
    or infinite makes the mean of its own periods NaN and touches no others.
    """
    if before_days < 1 or after_days < 1 or during_days < 0:
        raise ValueError("before_days and after_days must be >= 1 and during_days >= 0")
    periods = {"before": (-before_days, -1), "during": (-during_days, during_days), "after": (1, after_days)}
    # Kept out of the running totals, where it would reach every later day.
    odd = F.isnan("sum_stars") | (F.abs("sum_stars") == F.lit(float("inf")))
    rated = daily.filter(F.col("n_stars") > 0).withColumns({
        "n_odd": int_flag(odd), "sum_stars": F.when(odd, 0.0).otherwise(F.col("sum_stars"))})
    totals = period_totals(rated, events, periods, ["n_stars", "sum_stars", "n_odd"])
    columns: list[Column] = []
    for name in periods:
        n = F.nullif(F.col(f"n_stars_{name}"), F.lit(0))
        mean = F.when(F.col(f"n_odd_{name}") > 0, F.lit(float("nan"))).otherwise(F.col(f"sum_stars_{name}") / n)
        columns += [mean.alias(f"avg_stars_{name}"), n.alias(f"n_reviews_{name}")]
    any_rated = F.greatest(*[F.col(f"n_stars_{name}") for name in periods]) > 0
    return totals.filter(any_rated).select(*EVENT_KEY, *columns)


def rating_impact(events: DataFrame, daily: DataFrame, before_days: int = 30, during_days: int = 0,
                  after_days: int = 30) -> DataFrame:
    """All event columns plus the rating periods and their lengths."""
    periods = rating_periods(daily, events, before_days, during_days, after_days)
    return events.join(periods, EVENT_KEY, "left").withColumns({
        "before_days": F.lit(before_days),
        "during_days": F.lit(during_days),
        "after_days": F.lit(after_days),
    })


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event: of repeated keys, the smallest row by column order.

    An aggregate rather than a window, so copies collapse map-side.
    """
    rest = [c for c in events.columns if c not in EVENT_KEY]
    if not rest:
        return events.distinct()
    return (
        events.filter(F.col("business_id").isNotNull() & F.col("spike_date").isNotNull())
        .groupBy(*EVENT_KEY).agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*[F.col(c) if c in EVENT_KEY else F.col(f"_row.{c}").alias(c) for c in events.columns])
    )


def volume_counts(daily: DataFrame, events: DataFrame, window_days: int = VOLUME_WINDOW_DAYS) -> DataFrame:
    """Reviews before, on and after each event day; events without any review in reach are absent."""
    named = {"before_spike": (-window_days, -1), "on_spike_date": (0, 0), "after_spike": (1, window_days)}
    totals = period_totals(daily, events, named, ["n_reviews"])
    counts = {f"reviews_{name}": F.col(f"n_reviews_{name}") for name in named}
    return totals.filter(F.greatest(*counts.values()) > 0).select(
        *EVENT_KEY, *[n.alias(name) for name, n in counts.items()])


def volume_impact(events: DataFrame, daily: DataFrame, window_days: int = VOLUME_WINDOW_DAYS) -> DataFrame:
    """Volume around each event, its change, label and the share of flagged reviews.

    ``suspicious_review_share`` sets the flagged reviews of the event's own
    window against all reviews of this comparison window.
    """
    picked = dedupe_events(events.select(
        *EVENT_KEY, F.col("review_count").alias("spike_day_review_count"), "baseline_mean",
        "abs_increase", "z_score", "suspicious_reviews_in_window", "suspicious_user_count"))
    before, on, after = (F.col(c) for c in
                         ("reviews_before_spike", "reviews_on_spike_date", "reviews_after_spike"))
    change, pct = F.col("after_minus_before"), F.col("after_before_pct_change")
    total = F.col("total_reviews_in_impact_window")
    share = F.round(ratio(F.col("suspicious_reviews_in_window"), total), 4)
    return (
        picked.join(volume_counts(daily, picked, window_days), EVENT_KEY)
        .withColumn("window_days", F.lit(window_days))
        .withColumn("after_minus_before", after - before)
        .withColumn("after_before_pct_change", F.round(ratio(change, before) * 100, 2))
        .withColumn("total_reviews_in_impact_window", before + on + after)
        .withColumn("suspicious_review_share", F.coalesce(share, F.lit(0.0)))
        .withColumn("has_suspicious_users", int_flag(F.col("suspicious_user_count") > 0))
        .withColumn("volume_change_label",
                    F.when(change > 0, "increased").when(change < 0, "decreased").otherwise("no_change"))
        .withColumn("meaningful_increase_flag",
                    int_flag((change >= MEANINGFUL_INCREASE) | (pct >= MEANINGFUL_PCT_CHANGE)))
        .select(
            *EVENT_KEY, "window_days", "spike_day_review_count", "baseline_mean", "abs_increase",
            "z_score", "suspicious_reviews_in_window", "suspicious_user_count",
            "total_reviews_in_impact_window", "suspicious_review_share", "has_suspicious_users",
            "reviews_before_spike", "reviews_on_spike_date", "reviews_after_spike",
            "after_minus_before", "after_before_pct_change", "volume_change_label",
            "meaningful_increase_flag",
        )
    )


def spike_timeline(daily: DataFrame, events: DataFrame, plot_days: int = 30) -> DataFrame:
    """Daily reviews and mean stars within ``plot_days`` of every event."""
    if not 7 <= plot_days <= 180:
        raise ValueError("plot_days must be between 7 and 180")
    return (
        daily.join(event_days(events, plot_days, plot_days), ["business_id", "review_date"])
        .select(*EVENT_KEY, "review_date", F.col("n_reviews").alias("reviews"),
                ratio(F.col("sum_stars"), F.col("n_stars")).alias("avg_stars"))
    )
