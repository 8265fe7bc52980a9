"""Profiles, key figures, distributions and ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.quantiles import exact_quantiles
from candor.operators.prepare import rating_delta
from candor.schemas import EVENT_KEY

# Columns and thresholds of the reports.
VOLUME_PROFILE_COLUMNS = ["reviews_before_spike", "reviews_on_spike_date", "reviews_after_spike",
                          "after_minus_before", "after_before_pct_change", "suspicious_review_share"]
ANOMALY_PROFILE_COLUMNS = ["avg_stars_given", "pct_5_star_reviews", "review_count", "reviews_per_day",
                           "num_friends"]
CORRELATION_COLUMNS = ["avg_stars_given", "pct_5_star_reviews", "pct_1_star_reviews", "review_count",
                       "reviews_per_day", "num_friends", "anomaly_score"]
RATING_COLUMNS = ["user_id", "review_count", "avg_stars_given", "reviews_per_day", "num_friends"]
RANK_COLUMNS = ["user_id", "review_count", "reviews_per_day", "num_friends", "anomaly_score"]
CHANGE_COLUMNS = [*EVENT_KEY, "reviews_before_spike", "reviews_after_spike", "after_minus_before",
                  "after_before_pct_change", "suspicious_user_count"]
STRONG_COLUMNS = ["business_id", "name", "spike_date", "reviews_before_spike", "reviews_on_spike_date",
                  "reviews_after_spike", "after_minus_before", "after_before_pct_change",
                  "suspicious_reviews_in_window", "suspicious_user_count", "suspicious_review_share"]
HIGH_RATING, LOW_RATING = 4.5, 1.5
BOMBER_REVIEWS_PER_DAY = 0.1
EXTREME_SHARE = 0.95
HISTOGRAM_BINS, FALLBACK_BINS = 44, 24
DEFAULT_LIMIT, MAX_LIMIT = 50, 500


def _checked(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return limit


# ---- profiles -----------------------------------------------------------------------------------

def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, interpolated quartiles and maximum per column."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        stats.append(F.struct(
            F.lit(c).alias("column"), F.count(value).alias("count"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"), F.min(value).alias("min"), q[0].alias("q25"),
            q[1].alias("median"), q[2].alias("q75"), F.max(value).alias("max")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and surplus rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = F.sum("n")
    ids = F.count(key)
    return per_key.agg(F.coalesce(rows, F.lit(0)).alias("total_rows"), ids.alias("unique_ids"),
                       F.coalesce(rows - ids, F.lit(0)).alias("duplicate_ids"))


def missingness(df: DataFrame) -> DataFrame:
    """Missing values per column, count and percentage to six digits."""
    total = F.count(F.lit(1))
    rows = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing"),
                     F.round(F.count_if(F.col(c).isNull()) / total * 100, 6).alias("missing_pct"))
            for c in df.columns]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def incomplete_users(df: DataFrame) -> DataFrame:
    """The users without an account age or a friend count."""
    return df.filter(F.col("account_age_days").isNull() | F.col("num_friends").isNull())


def feature_correlation(df: DataFrame, columns: list[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form, from one aggregation.

    Each unordered pair is computed once and listed both ways.
    """
    cells = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            r = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
            cells.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), r.alias("correlation")))
            if a != b:
                cells.append(F.struct(F.lit(b).alias("column_a"), F.lit(a).alias("column_b"),
                                      r.alias("correlation")))
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def correlation_with(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Correlation of each column with ``target``, strongest first."""
    return (feature_correlation(df, columns).filter(F.col("column_a") == target)
            .orderBy(F.desc_nulls_last("correlation"), "column_b"))


# ---- key figures --------------------------------------------------------------------------------

def volume_label_counts(volume: DataFrame) -> DataFrame:
    """Event counts by change label, meaningful flag and flagged-user involvement."""
    columns = ["volume_change_label", "meaningful_increase_flag", "has_suspicious_users"]
    entries = [F.struct(F.lit(c).alias("report"), F.col(c).cast("string").alias("value")) for c in columns]
    return (volume.select(F.explode(F.array(*entries)).alias("e")).groupBy("e.report", "e.value")
            .agg(F.count(F.lit(1)).alias("events")))


def volume_kpis(volume: DataFrame) -> DataFrame:
    median = exact_quantiles(volume, {"after_before_pct_change": [0.5]})["after_before_pct_change"][0]
    label = F.col("volume_change_label")
    return volume.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(label == "increased").alias("increased"),
        F.count_if(label == "decreased").alias("decreased"),
        F.sum("meaningful_increase_flag").alias("meaningful"),
        F.sum("has_suspicious_users").alias("with_suspicious_users"),
        F.avg("reviews_before_spike").alias("mean_before"),
        F.avg("reviews_after_spike").alias("mean_after"),
        F.lit(median).cast("double").alias("median_pct_change"),
    )


def delta_kpis(impact: DataFrame, cases: DataFrame) -> DataFrame:
    """Rating-change figures and the number of cases with a known change."""
    known = rating_delta(impact).dropna(subset=["delta_after_before"])
    median = exact_quantiles(known, {"delta_after_before": [0.5]})["delta_after_before"][0]
    joined = cases.join(known.select(*EVENT_KEY), EVENT_KEY).agg(F.count(F.lit(1)))
    return known.agg(
        F.count(F.lit(1)).alias("events"),
        F.lit(median).cast("double").alias("median_delta"),
        F.avg("delta_after_before").alias("mean_delta"),
        F.min("delta_after_before").alias("min_delta"),
        F.max("delta_after_before").alias("max_delta"),
    ).withColumn("joined_points", joined.scalar())


def overview_kpis(businesses: DataFrame, impact: DataFrame) -> DataFrame:
    """Spike days, those with flagged users, their businesses, and impact events."""
    flagged = F.col("suspicious_user_count") > 0
    return businesses.agg(
        F.count(F.lit(1)).alias("spike_days"),
        F.count_if(flagged).alias("spike_days_with_suspicious_users"),
        F.countDistinct(F.when(flagged, F.col("business_id"))).alias("unique_suspicious_businesses"),
    ).withColumn("impact_events", impact.agg(F.count(F.lit(1))).scalar())


def zero_friend_counts(scores: DataFrame, top: int = 500) -> DataFrame:
    """Flagged users, those without friends, and those without friends among the top ones."""
    lonely = F.col("num_friends") == 0
    flagged = scores.filter(F.col("is_anomaly") == 1)
    head = flagged.orderBy(F.desc("anomaly_score"), "user_id").limit(top).agg(F.count_if(lonely))
    return flagged.agg(F.count(F.lit(1)).alias("anomalies"),
                       F.count_if(lonely).alias("zero_friend_anomalies")
                       ).withColumn("zero_friend_top", head.scalar())


# ---- distributions ------------------------------------------------------------------------------

def histogram(df: DataFrame, column: str, bins: int, right_closed: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included.

    Bins are closed on the left and the last also on the right, or the other
    way round with ``right_closed``; then the first edge lies a thousandth of the
    whole width below the minimum, which its bin holds too.
    """
    x = F.col(column)
    known = df.filter(x.isNotNull()).select(x.cast("double").alias("x"))
    ends = known.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("ends"))
    lo, hi = ends.scalar().getField("lo"), ends.scalar().getField("hi")
    place = (F.col("x") - F.col("lo")) / F.col("width")
    raw = F.ceil(place) - 1 if right_closed else F.floor(place)
    index = F.when(F.col("width") > 0, raw).otherwise(0)
    counted = (
        known.withColumn("lo", lo).withColumn("width", (hi - lo) / bins)
        .select(F.least(F.greatest(index, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    edges = (
        ends.select("ends.lo", ((F.col("ends.hi") - F.col("ends.lo")) / bins).alias("width"),
                    F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select("bin", (F.col("lo") + F.col("bin") * F.col("width") - F.when(
                    (F.col("bin") == 0) & F.lit(right_closed), F.col("width") * bins * 0.001).otherwise(0.0)).alias("bin_start"),
                (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"))
    )
    return edges.join(counted, "bin", "left").select(
        F.lit(bins).alias("bins"), "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("events"))


def delta_histogram(impact: DataFrame) -> DataFrame:
    """Rating changes in 44 bins, and in the 24 right-closed bins of the plain view."""
    deltas = rating_delta(impact)
    return histogram(deltas, "delta_after_before", HISTOGRAM_BINS).unionByName(
        histogram(deltas, "delta_after_before", FALLBACK_BINS, right_closed=True))


def delta_box(impact: DataFrame) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 box lengths) and outliers of rating changes."""
    deltas = rating_delta(impact).dropna(subset=["delta_after_before"])
    q1, q2, q3 = exact_quantiles(deltas, {"delta_after_before": [0.25, 0.5, 0.75]})["delta_after_before"]
    d = F.col("delta_after_before")
    q1c, q2c, q3c = (F.lit(q).cast("double") for q in (q1, q2, q3))
    inside = d.between(q1c - 1.5 * (q3c - q1c), q3c + 1.5 * (q3c - q1c))
    return deltas.agg(
        q1c.alias("q1"), q2c.alias("median"), q3c.alias("q3"),
        F.min(F.when(inside, d)).alias("lower_whisker"), F.max(F.when(inside, d)).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"))


# ---- ranked lists -------------------------------------------------------------------------------

def top_rows(df: DataFrame, order: list[Column], limit: int, columns: list[str] | None = None,
             where: Column | None = None) -> DataFrame:
    """Filter, order, cut: planned as a distributed top-k, never a full sort."""
    kept = df.filter(where) if where is not None else df
    return (kept.orderBy(*order).limit(limit).select(*(columns or df.columns)))


def top_volume_events(volume: DataFrame, limit: int = 20) -> DataFrame:
    return top_rows(volume, [F.desc("spike_day_review_count"), F.desc("suspicious_reviews_in_window"),
                             *map(F.col, EVENT_KEY)], limit)


def top_suspicious_users(scores: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Flagged users by rank, or by score if no rank is given."""
    by = F.col("anomaly_rank") if "anomaly_rank" in scores.columns else F.desc("anomaly_score")
    where = F.col("is_anomaly") == 1 if "is_anomaly" in scores.columns else None
    return top_rows(scores, [by, F.col("user_id")], _checked(limit), where=where)


def top_suspicious_businesses(businesses: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return top_rows(businesses, [F.desc_nulls_last("z_score"), F.desc_nulls_last("suspicious_user_count"),
                                 *map(F.col, EVENT_KEY)], _checked(limit))


def _top_anomalies(scores: DataFrame, where: Column, limit: int, columns: list[str] | None = None) -> DataFrame:
    return top_rows(scores, [F.desc("anomaly_score"), F.col("user_id")], limit, columns,
                    (F.col("is_anomaly") == 1) & where)


def anomaly_bots(scores: DataFrame, limit: int = 10) -> DataFrame:
    return _top_anomalies(scores, F.col("num_friends") == 0, limit)


def anomaly_bombers(scores: DataFrame, limit: int = 10, min_per_day: float = BOMBER_REVIEWS_PER_DAY) -> DataFrame:
    return _top_anomalies(scores, F.col("reviews_per_day") > min_per_day, limit)


def anomaly_rating_extremes(scores: DataFrame, limit: int = 10) -> DataFrame:
    """Top flagged users with very high and with very low ratings."""
    def side(name: str, where: Column) -> DataFrame:
        return _top_anomalies(scores, where, limit, RATING_COLUMNS).withColumn("side", F.lit(name))
    return side("high", F.col("avg_stars_given") >= HIGH_RATING).unionByName(
        side("low", F.col("avg_stars_given") <= LOW_RATING))


def anomaly_pct_extremes(scores: DataFrame, limit: int = 10) -> DataFrame:
    """Top flagged users who give almost only fives or almost only ones."""
    where = (F.col("pct_5_star_reviews") > EXTREME_SHARE) | (F.col("pct_1_star_reviews") > EXTREME_SHARE)
    return _top_anomalies(scores, where, limit)


def anomaly_rank_top(scores: DataFrame, ranks: int = 5) -> DataFrame:
    return scores.filter(F.col("anomaly_rank") <= ranks).select(*RANK_COLUMNS)


def friends_vs_score(scores: DataFrame) -> DataFrame:
    return scores.select("num_friends", "anomaly_score", "is_anomaly")


def volume_increases(volume: DataFrame, limit: int = 5) -> DataFrame:
    return top_rows(volume, [F.desc("after_minus_before"), *map(F.col, EVENT_KEY)], limit, CHANGE_COLUMNS,
                    F.col("after_minus_before") > 0)


def volume_decreases(volume: DataFrame, limit: int = 5) -> DataFrame:
    return top_rows(volume, [F.asc("after_minus_before"), *map(F.col, EVENT_KEY)], limit, CHANGE_COLUMNS,
                    F.col("after_minus_before") < 0)


def growth_cases(volume: DataFrame, limit: int = 10) -> DataFrame:
    where = (F.col("volume_change_label") == "increased") & (F.col("meaningful_increase_flag") == 1)
    return top_rows(volume, [F.desc_nulls_last("after_before_pct_change"), *map(F.col, EVENT_KEY)], limit,
                    where=where)


def suspicious_user_cases(volume: DataFrame, limit: int = 10) -> DataFrame:
    return top_rows(volume, [F.desc("suspicious_user_count"), *map(F.col, EVENT_KEY)], limit,
                    where=F.col("has_suspicious_users") == 1)


def meaningful_events(volume: DataFrame) -> DataFrame:
    return volume.filter(F.col("meaningful_increase_flag") == 1)


def volume_case_studies(volume: DataFrame, businesses: DataFrame) -> DataFrame:
    """Volume impact with all business columns."""
    return volume.join(businesses, "business_id", "left")


def strong_cases(volume: DataFrame, businesses: DataFrame, limit: int = 10) -> DataFrame:
    """Events with flagged users and meaningful growth."""
    where = (F.col("has_suspicious_users") == 1) & (F.col("meaningful_increase_flag") == 1)
    return top_rows(volume_case_studies(volume, businesses),
                    [F.desc("suspicious_user_count"), F.desc("after_minus_before"), *map(F.col, EVENT_KEY)],
                    limit, STRONG_COLUMNS, where)
