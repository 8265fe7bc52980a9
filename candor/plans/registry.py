"""The queries by name: a Spark callable each, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candor.functions.ranking import global_row_number
from candor.functions.scalars import friend_count, rounded
from candor.operators import (authenticity, communities, features, forest, graph, impact, level_forest, prepare,
                              records, reports, rules, spikes)
from candor.plans.chain import analyse
from candor.plans.oracle import (EVENT_DOUBLES, FEATURE_DOUBLES, STAR_DOUBLES, SUSBIZ_DOUBLES, VOLUME_DOUBLES,
                                 oracle)
from candor.schemas import BUSINESS_INFO_COLUMNS, FEATURE_COLUMNS, RAW_SCHEMAS, SIGNUP_COLUMN
from candor.session import scratch_path, stored
from candor.sources import star_views as views
from candor.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The default rate of 0.1 reviews a day is out of reach in these tables
# (about 40 reviews in ten years per user), so the list is asked at this rate.
BOMBER_RATE = 0.01


class Inputs:
    """The shared tables of one data set, built from the views.

    A table that several parts of one query read is written once per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self._written: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._written:
            self._written[name] = stored(build(), name)
        return self._written[name]

    def businesses(self) -> DataFrame:
        return views.businesses(self.spark, self.sf)

    def restaurants(self) -> DataFrame:
        return prepare.restaurants_base(self.businesses())

    def reviews(self) -> DataFrame:
        return prepare.restaurant_reviews(
            prepare.reviews_base(views.reviews(self.spark, self.sf)), self.restaurants())

    def narrow_reviews(self) -> DataFrame:
        """Restaurant reviews without text, for queries that read them more than once."""
        return self.once("reviews", lambda: self.reviews().select("user_id", "business_id", "stars", "date"))

    def users(self) -> DataFrame:
        return prepare.users_base(views.raw_users(self.spark, self.sf))

    def flags(self) -> DataFrame:
        return views.user_flags(self.spark, self.sf)

    def clusters(self) -> DataFrame:
        return views.user_clusters(self.spark, self.sf)

    def features(self) -> DataFrame:
        return features.user_features(self.reviews(), self.users(), views.AS_OF)

    def scores(self) -> DataFrame:
        """Complete users with the stand-in scores and flags."""
        complete = prepare.drop_incomplete_users(self.once("features", self.features))
        return complete.join(self.flags(), "user_id")

    def ranked_scores(self) -> DataFrame:
        return global_row_number(self.scores(), [F.desc("anomaly_score"), F.col("user_id")], "anomaly_rank")

    def events(self) -> DataFrame:
        """Spike events, from the narrow reviews."""
        return spikes.spike_events(spikes.review_spikes(self.narrow_reviews(), **views.TUNED_RULE))

    def daily(self) -> DataFrame:
        return spikes.daily_totals(self.narrow_reviews())

    def suspicious_businesses(self) -> DataFrame:
        return self.once("suspicious-businesses", lambda: impact.suspicious_businesses(
            self.once("events", self.events), self.narrow_reviews(), self.flags()))

    def rating(self) -> DataFrame:
        return impact.rating_impact(self.suspicious_businesses(), self.daily())

    def volume(self) -> DataFrame:
        return impact.volume_impact(self.suspicious_businesses(), self.daily())

    def names(self) -> DataFrame:
        return tables.business_names(self.businesses())

    def cases(self) -> DataFrame:
        return authenticity.with_names(
            authenticity.suspicious_cases(self.suspicious_businesses()), self.names())

    def edges(self) -> DataFrame:
        return graph.user_similarity_edges(self.reviews(), self.flags())

    def graph(self) -> DataFrame:
        return graph.co_reviewer_graph(graph.flagged_reviews(self.reviews(), self.flags()))

    def model_scores(self) -> DataFrame:
        return forest.user_anomaly_scores(self.once("features", self.features))


def query(name: str, uses: list[str] | None = None, sql: str | None = None, doubles: list[str] | None = None):
    """Register ``fn(inputs) -> DataFrame``; its doubles are rounded to six digits."""

    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(Inputs(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = oracle(uses or [], sql, doubles)
        return fn

    return register


def _columns(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


# ---- sources and sinks --------------------------------------------------------------------------

@query("src_json_roundtrip", ["reviews"], """
    SELECT review_id, CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, stars,
           strftime(date, '%Y-%m-%d %H:%M:%S') AS date, text, length(text) AS useful FROM reviews""")
def src_json_roundtrip(i):
    """Raw lines with an undeclared field, stars as text, and lines that are no JSON beside them."""
    path = scratch_path(i.spark, "json")
    raw = views.raw_reviews(i.spark, i.sf).withColumns({c: F.col(c).cast("string") for c in ("user_id", "business_id", "stars")})
    raw = raw.withColumn("useful", F.length("text"))
    broken = i.businesses().select(F.concat(F.lit('{"name": "'), "name").alias("value"))
    raw.select(F.to_json(F.struct("*")).alias("value")).union(broken).write.text(path, compression="gzip")
    df = tables.raw_table(i.spark, path, RAW_SCHEMAS["review"])
    return df.filter(F.col(tables.CORRUPT).isNull()).drop(tables.CORRUPT).withColumn("useful", F.col("useful").cast("long"))


@query("src_convert_raw", ["users", "businesses"], """
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           CASE user_id % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["f"]' WHEN 2 THEN '["f","f"]' ELSE '["f","f","f"]' END AS friends,
           CAST(user_id % 4 AS INTEGER) AS num_friends,
           (SELECT count(*) FROM businesses) AS corrupt_lines FROM users""")
def src_convert_raw(i):
    """Users whose friends are JSON arrays, the empty one among them, beside lines that are no JSON."""
    raw, out = scratch_path(i.spark, "raw"), scratch_path(i.spark, "converted")
    users = views.raw_users(i.spark, i.sf).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.array_repeat(F.lit("f"), (F.col("user_id") % 4).cast("int")).alias("friends"))
    broken = i.businesses().select(F.concat(F.lit('{"user_id": '), "name").alias("value"))
    users.select(F.to_json(F.struct("*")).alias("value")).union(broken).write.text(f"{raw}/user.json")
    counts = tables.convert_raw(i.spark, raw, out)["user"]
    df = tables.read_table(i.spark, f"{out}/user")
    return df.select("user_id", "friends", friend_count(df).alias("num_friends"),
                     F.lit(counts["corrupt"]).cast("long").alias("corrupt_lines"))


@query("src_parquet_scan", [], "SELECT * FROM customer", ["c_acctbal"])
def src_parquet_scan(i):
    return tables.read_table(i.spark, f"{i.sf}/customer.parquet")


@query("src_business_names", ["names"], "SELECT * FROM names")
def src_business_names(i):
    """The reader on a table in which ids repeat under other names."""
    path = scratch_path(i.spark, "names")
    shops = i.businesses().select("business_id", "name")
    tables.write_table(shops.union(shops.select("business_id", F.concat("name", F.lit(" (closed)")))), path)
    return tables.read_business_names(i.spark, path)


@query("sink_parquet_roundtrip", ["restaurants"], "SELECT * FROM restaurants")
def sink_parquet_roundtrip(i):
    path = scratch_path(i.spark, "parquet")
    tables.write_table(i.restaurants(), path)
    return tables.read_table(i.spark, path)


@query("sink_partitioned_roundtrip", ["reviews_b"], "SELECT * FROM reviews_b")
def sink_partitioned_roundtrip(i):
    path = scratch_path(i.spark, "by-year")
    out = prepare.reviews_base(views.reviews(i.spark, i.sf))
    tables.write_table(out, path, "review_year")
    return tables.read_table(i.spark, path, out.columns)


SHARED_CASE_COLUMNS = ["review_count", *EVENT_DOUBLES, "history_days", "total_reviews_in_window",
                       "suspicious_reviews_in_window", "suspicious_user_count", "max_anomaly_score", "avg_anomaly_score",
                       "window_days"]
CASE_IMPACT_DOUBLES = [*SUSBIZ_DOUBLES, *(f"{c}_impact" for c in SUSBIZ_DOUBLES), *STAR_DOUBLES,
                       "delta_after_before"]


@query("sink_csv_cases", ["cases", "names", "impact"], f"""
    SELECT c.*, {", ".join(f"i.{c} AS {c}_impact" for c in SHARED_CASE_COLUMNS)},
           i.avg_stars_before, i.n_reviews_before, i.avg_stars_during, i.n_reviews_during, i.avg_stars_after,
           i.n_reviews_after, i.before_days, i.during_days, i.after_days, i.delta_after_before,
           concat('  "', c.name, '", said' || chr(10) || 'they  ') AS note
    FROM cases c LEFT JOIN (SELECT * FROM impact WHERE abs(avg_stars_after - avg_stars_before) > 0.3) i
      ON c.business_id = i.business_id AND c.spike_date = i.spike_date""", CASE_IMPACT_DOUBLES)
def sink_csv_cases(i):
    """Cases with the changed ratings, where there is one, and a text with blanks, quotes and a line break."""
    path = scratch_path(i.spark, "csv")
    changed = i.rating().filter("abs(avg_stars_after - avg_stars_before) > 0.3")
    note = F.concat(F.lit('  "'), "name", F.lit('", said\nthey  '))
    out = authenticity.with_impact(i.cases(), changed, how="left").withColumn("note", note)
    tables.write_csv(out, path)
    return tables.read_csv(i.spark, path, out.schema)


@query("json_safe_records", ["susbiz", "restaurants"], """
    SELECT CAST(to_json(struct_pack(
        business_id := s.business_id, spike_date := strftime(spike_date, '%Y-%m-%d'), review_count := review_count,
        baseline_mean := round(baseline_mean, 6), baseline_std := round(baseline_std, 6), history_days := history_days,
        abs_increase := round(abs_increase, 6), z_score := round(z_score, 6),
        total_reviews_in_window := total_reviews_in_window,
        suspicious_reviews_in_window := suspicious_reviews_in_window,
        suspicious_user_count := suspicious_user_count, max_anomaly_score := round(max_anomaly_score, 6),
        avg_anomaly_score := round(avg_anomaly_score, 6), window_days := window_days,
        business := struct_pack(name := r.name, city := r.city, state := r.state, categories := r.categories)
    )) AS VARCHAR) AS record
    FROM susbiz s JOIN restaurants r ON s.business_id = r.business_id""")
def json_safe_records(i):
    return records.json_records(rounded(authenticity.enrich_business(i.suspicious_businesses(), i.restaurants())))


# ---- base tables --------------------------------------------------------------------------------

@query("prep_review_year", ["reviews"], "SELECT * FROM reviews")
def prep_review_year(i):
    return prepare.add_review_year(views.raw_reviews(i.spark, i.sf))


@query("restaurants_base", ["restaurants"], "SELECT * FROM restaurants")
def restaurants_base(i):
    return i.restaurants()


@query("reviews_base", ["reviews_b"], "SELECT * FROM reviews_b")
def reviews_base(i):
    return prepare.reviews_base(views.reviews(i.spark, i.sf))


@query("users_base", ["users_b"], "SELECT * FROM users_b")
def users_base(i):
    return i.users()


@query("restaurant_reviews", ["rr"], "SELECT * FROM rr")
def restaurant_reviews(i):
    return i.reviews()


@query("join_reviews_users_left", ["rr", "users_b"], f"""
    SELECT rr.*, u.{SIGNUP_COLUMN} FROM rr LEFT JOIN users_b u ON rr.user_id = u.user_id""")
def join_reviews_users_left(i):
    return prepare.with_signup(i.reviews(), i.users())


@query("fill_user_features", ["filled"], "SELECT * FROM filled", FEATURE_DOUBLES)
def fill_user_features(i):
    return prepare.fill_user_features(i.features())


@query("drop_incomplete_users", ["features"], """
    SELECT * FROM features WHERE account_age_days IS NOT NULL AND num_friends IS NOT NULL""", FEATURE_DOUBLES)
def drop_incomplete_users(i):
    return prepare.drop_incomplete_users(i.once("features", i.features))


@query("incomplete_users", ["features"], """
    SELECT * FROM features WHERE account_age_days IS NULL OR num_friends IS NULL""", FEATURE_DOUBLES)
def incomplete_users(i):
    return reports.incomplete_users(i.once("features", i.features))


@query("coerce_numeric", ["rr"], """
    SELECT review_id, try_cast(CAST(stars AS VARCHAR) AS DOUBLE) AS stars, try_cast(text AS DOUBLE) AS text,
           CASE WHEN stars < 2 THEN stars * 1e308 END AS huge FROM rr""")
def coerce_numeric(i):
    mixed = i.reviews().select("review_id", F.col("stars").cast("string").alias("stars"), "text",
                               (F.col("stars") * F.lit(1e308)).alias("huge"))
    return prepare.coerce_numeric(mixed, ["stars", "text", "huge"])


# ---- features and rules -------------------------------------------------------------------------

@query("user_review_sequence", ["rr"], """
    SELECT review_id, user_id, date, row_number() OVER (PARTITION BY user_id ORDER BY date NULLS LAST,
           review_id NULLS LAST) AS user_review_sequence FROM rr""")
def user_review_sequence(i):
    return features.user_review_sequence(i.reviews().select("review_id", "user_id", "date"))


@query("user_review_sequence_split", ["rr"], """
    SELECT review_id, user_id, date, row_number() OVER (PARTITION BY user_id ORDER BY date NULLS LAST,
           review_id NULLS LAST) AS user_review_sequence FROM rr""")
def user_review_sequence_split(i):
    """The same numbers with every user of more than 30 reviews numbered by the range sort."""
    narrow = stored(i.reviews().select("review_id", "user_id", "date"), "narrow-reviews")
    return features.user_review_sequence(narrow, hot_rows=30)


@query("review_features", ["rr", "users_b"], f"""
    SELECT review_id, business_id, rr.user_id, date, review_year, stars, CAST(length(text) AS INTEGER) AS review_length,
           CAST(hour(date) AS INTEGER) AS review_hour, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
           CAST(CAST(date AS DATE) - CAST({SIGNUP_COLUMN} AS DATE) AS INTEGER) AS days_since_signup,
           row_number() OVER (PARTITION BY rr.user_id ORDER BY date NULLS LAST, review_id NULLS LAST) AS user_review_sequence
    FROM rr LEFT JOIN users_b u ON rr.user_id = u.user_id""")
def review_features(i):
    return features.review_features(i.reviews(), i.users())


@query("user_review_stats", ["stats"], "SELECT * FROM stats",
       ["avg_stars_given", "pct_5_star_reviews", "pct_1_star_reviews"])
def user_review_stats(i):
    return features.user_review_stats(i.reviews())


@query("user_num_friends", ["friends"], "SELECT user_id, num_friends FROM friends")
def user_num_friends(i):
    return features.user_profile(i.users(), views.AS_OF).select("user_id", "num_friends")


@query("user_features", ["features"], "SELECT * FROM features", FEATURE_DOUBLES)
def user_features(i):
    return i.features()


@query("rule_based_scores", ["rules"], "SELECT * FROM rules", [*FEATURE_DOUBLES, "rule_based_score"])
def rule_based_scores(i):
    return rules.rule_based_scores(i.features())


@query("rule_flag_counts", ["rules"], """
    SELECT CASE WHEN grouping(rule_based_score) = 0 THEN 'score' WHEN grouping(is_flagged_suspicious) = 0 THEN 'verdict'
                WHEN grouping(extreme_rating_flag) = 0 AND grouping(review_burst_flag) = 0 THEN 'combination'
                WHEN grouping(extreme_rating_flag) = 0 THEN 'extreme_rating_flag'
                WHEN grouping(review_burst_flag) = 0 THEN 'review_burst_flag' ELSE 'low_friends_flag' END AS report,
           rule_based_score, is_flagged_suspicious, extreme_rating_flag, review_burst_flag, low_friends_flag,
           count(*) AS users
    FROM rules GROUP BY GROUPING SETS ((rule_based_score), (is_flagged_suspicious), (extreme_rating_flag),
         (review_burst_flag), (low_friends_flag), (extreme_rating_flag, review_burst_flag, low_friends_flag))""")
def rule_flag_counts(i):
    return rules.rule_flag_counts(rules.rule_based_scores(i.features()))


@query("top_rule_users", ["rules"], """
    SELECT * FROM rules ORDER BY is_flagged_suspicious DESC, rule_based_score DESC, review_count DESC, user_id
    LIMIT 20""", [*FEATURE_DOUBLES, "rule_based_score"])
def top_rule_users(i):
    return rules.top_rule_users(rules.rule_based_scores(i.features()))


# ---- spikes -------------------------------------------------------------------------------------

@query("daily_review_counts", ["daily"], "SELECT * FROM daily")
def daily_review_counts(i):
    return spikes.daily_review_counts(i.reviews())


@query("rolling_baseline", ["base"], "SELECT * FROM base", ["baseline_mean", "baseline_std"])
def rolling_baseline(i):
    return spikes.rolling_baseline(spikes.daily_review_counts(i.reviews()))


@query("review_spikes", ["spikes"], "SELECT * FROM spikes", EVENT_DOUBLES)
def review_spikes(i):
    return spikes.review_spikes(i.reviews(), **views.TUNED_RULE)


@query("review_spikes_default_rule", ["spikes_default"], "SELECT * FROM spikes_default", EVENT_DOUBLES)
def review_spikes_default_rule(i):
    return spikes.review_spikes(i.reviews())


@query("spike_events", ["events"], "SELECT * FROM events", EVENT_DOUBLES)
def spike_events(i):
    return spikes.spike_events(spikes.review_spikes(i.reviews(), **views.TUNED_RULE))


# ---- activity and impact around spikes ----------------------------------------------------------

@query("anomalous_users", ["flagged"], "SELECT * FROM flagged", ["anomaly_score"])
def anomalous_users(i):
    return impact.anomalous_users(i.flags())


@query("interval_join_spike_reviews", ["in_window3"], """
    SELECT business_id, spike_date, review_id, user_id, review_date FROM in_window3""")
def interval_join_spike_reviews(i):
    return impact.spike_window_reviews(i.reviews(), i.events(), 3).select(
        "business_id", "spike_date", "review_id", "user_id", "review_date")


@query("join_suspicious_reviews", ["in_window3", "flagged"], """
    SELECT business_id, spike_date, review_id, w.user_id, review_date, anomaly_score
    FROM in_window3 w JOIN flagged f ON w.user_id = f.user_id""", ["anomaly_score"])
def join_suspicious_reviews(i):
    return impact.suspicious_window_reviews(i.reviews(), i.events(), i.flags(), 3)


@query("suspicious_window_aggs", ["sus_aggs"], "SELECT * FROM sus_aggs", ["max_anomaly_score", "avg_anomaly_score"])
def suspicious_window_aggs(i):
    return impact.suspicious_window_aggs(i.narrow_reviews(), i.events(), i.flags())


@query("suspicious_businesses", ["susbiz"], "SELECT * FROM susbiz", SUSBIZ_DOUBLES)
def suspicious_businesses(i):
    events = i.once("events", i.events)
    return impact.suspicious_businesses(events, i.narrow_reviews(), i.flags())


@query("suspicious_businesses_3_days", ["events", "in_window3", "flagged"], """
    SELECT e.*, coalesce(n, 0) AS total_reviews_in_window, coalesce(s_n, 0) AS suspicious_reviews_in_window,
           coalesce(s_u, 0) AS suspicious_user_count, max_anomaly_score, avg_anomaly_score, 3 AS window_days
    FROM events e
    LEFT JOIN (SELECT business_id, spike_date, count(*) AS n, count(anomaly_score) AS s_n,
                      count(DISTINCT CASE WHEN anomaly_score IS NOT NULL THEN w.user_id END) AS s_u,
                      max(anomaly_score) AS max_anomaly_score, avg(anomaly_score) AS avg_anomaly_score
               FROM in_window3 w LEFT JOIN flagged f ON w.user_id = f.user_id GROUP BY 1, 2)
      USING (business_id, spike_date)""", SUSBIZ_DOUBLES)
def suspicious_businesses_3_days(i):
    events = i.once("events", i.events)
    return impact.suspicious_businesses(events, i.narrow_reviews(), i.flags(), 3)


@query("interval_join_before_during_after", ["before", "during3", "after"], """
    SELECT business_id, spike_date, avg_stars_before, n_reviews_before, avg_stars_during, n_reviews_during,
           avg_stars_after, n_reviews_after
    FROM before FULL JOIN during3 USING (business_id, spike_date) FULL JOIN after USING (business_id, spike_date)""",
       STAR_DOUBLES)
def interval_join_before_during_after(i):
    return impact.rating_periods(i.daily(), i.events(), 30, 3, 30)


@query("rating_impact", ["rating"], "SELECT * FROM rating", [*SUSBIZ_DOUBLES, *STAR_DOUBLES])
def rating_impact(i):
    return i.rating()


@query("rating_delta", ["impact"], "SELECT * FROM impact", [*SUSBIZ_DOUBLES, *STAR_DOUBLES, "delta_after_before"])
def rating_delta(i):
    return prepare.rating_delta(i.rating())


@query("volume_impact", ["volume"], "SELECT * FROM volume", VOLUME_DOUBLES)
def volume_impact(i):
    return i.volume()


@query("dedupe_events", ["spikes", "spikes_default"], """
    SELECT business_id, review_date AS spike_date, min(rule) AS rule FROM (
        SELECT business_id, review_date, 'tuned' AS rule FROM spikes WHERE is_spike = 1
        UNION ALL SELECT business_id, review_date, 'default' FROM spikes_default WHERE is_spike = 1)
    GROUP BY 1, 2""")
def dedupe_events(i):
    tuned = i.events().select("business_id", "spike_date", F.lit("tuned").alias("rule"))
    default = spikes.spike_events(spikes.review_spikes(i.narrow_reviews())).select(
        "business_id", "spike_date", F.lit("default").alias("rule"))
    return impact.dedupe_events(tuned.unionByName(default))


@query("spike_timeline", ["rr", "susbiz"], """
    SELECT s.business_id, s.spike_date, CAST(r.date AS DATE) AS review_date, count(*) AS reviews, avg(stars) AS avg_stars
    FROM rr r JOIN susbiz s ON r.business_id = s.business_id
     AND CAST(r.date AS DATE) BETWEEN s.spike_date - 30 AND s.spike_date + 30 GROUP BY 1, 2, 3""", ["avg_stars"])
def spike_timeline(i):
    return impact.spike_timeline(i.daily(), i.events())


# ---- co-review graph and communities ------------------------------------------------------------

@query("co_review_pairs", ["pairs"], "SELECT * FROM pairs")
def co_review_pairs(i):
    flagged = i.once("flagged", lambda: graph.flagged_reviews(i.reviews(), i.flags()))
    return graph.co_review_pairs(flagged)


@query("co_review_pairs_in_cells", ["pairs"], "SELECT * FROM pairs")
def co_review_pairs_in_cells(i):
    """The same pairs with every span of more than four reviews laid out in cells."""
    flagged = i.once("flagged", lambda: graph.flagged_reviews(i.reviews(), i.flags()))
    return graph.co_review_pairs(flagged, cell_rows=4)


@query("user_similarity_edges", ["pairs"], "SELECT user_id_a, user_id_b, business_id, time_diff_days FROM pairs")
def user_similarity_edges(i):
    return i.edges()


@query("user_graph", ["pairs"], """
    SELECT least(user_id_a, user_id_b) AS user_a, greatest(user_id_a, user_id_b) AS user_b,
           count(DISTINCT business_id) AS weight FROM pairs GROUP BY 1, 2""")
def user_graph(i):
    return i.graph()


@query("user_communities")
def user_communities(i):
    return communities.louvain_communities(i.graph())


@query("user_clusters")
def user_clusters(i):
    return communities.user_clusters(communities.louvain_communities(i.graph()))


CLIQUE = 40


@query("planted_clusters", [], f"""
    SELECT c_custkey AS user_id, dense_rank() OVER (ORDER BY c_custkey // {CLIQUE}) - 1 AS cluster_id, n AS cluster_size
    FROM (SELECT c_custkey, count(*) OVER (PARTITION BY c_custkey // {CLIQUE}) AS n FROM customer) WHERE n >= 3""")
def planted_clusters(i):
    """Customers in groups by id, all linked within a group, and groups linked in a ring: the best labelling is the groups.

    The links between groups join everything, so plain components would not do. They weigh so little that joining
    two groups of any size from 2 to CLIQUE never pays, however many groups there are: with all weights 1 it would
    from some CLIQUE * CLIQUE groups on.
    """
    c = views.customers(i.spark, i.sf).distinct().select("user_id", F.expr(f"user_id div {CLIQUE}").alias("team"))
    other = c.select(F.col("user_id").alias("user_b"), "team")
    links = (c.select(F.col("user_id").alias("user_a"), "team").join(other, "team")
             .filter("user_a < user_b").select("user_a", "user_b"))
    ends = stored(c.groupBy("team").agg(F.min("user_id").alias("first"), F.max("user_id").alias("last")), "teams")
    after = ends.select((F.col("team") - 1).alias("team"), F.col("first").alias("next"))
    around = ends.agg(F.max_by("last", "team").alias("user_b"), F.min_by("first", "team").alias("user_a"),
                      F.count(F.lit(1)).alias("n")).where("n >= 3").select("user_a", "user_b")
    ring = ends.join(after, "team").select(F.col("last").alias("user_a"), F.col("next").alias("user_b")).unionByName(around)
    light = 1.0 / (CLIQUE * CLIQUE * max(1, ends.count()))
    weighted = links.withColumn("weight", F.lit(1.0)).unionByName(ring.withColumn("weight", F.lit(light)))
    return communities.user_clusters(communities.louvain_communities(weighted, "weight"))


@query("user_cluster_invariants", ["pairs"], """
    SELECT count(DISTINCT u) AS vertices, 0 AS repeated_vertices, 0 AS small_clusters, 0 AS numbers_left_out
    FROM (SELECT user_id_a AS u FROM pairs UNION ALL SELECT user_id_b FROM pairs)""")
def user_cluster_invariants(i):
    """Every linked user once, clusters of three or more, and dense numbers."""
    members = stored(communities.louvain_communities(i.graph()), "members")
    found = communities.user_clusters(members)
    of_members = members.agg(F.countDistinct("vertex").alias("vertices"),
                             (F.count(F.lit(1)) - F.countDistinct("vertex")).alias("repeated_vertices"))
    of_clusters = found.agg(F.count_if(F.col("cluster_size") < 3).alias("small_clusters"), F.coalesce(
        F.max("cluster_id") + 1 - F.countDistinct("cluster_id"), F.lit(0)).alias("numbers_left_out"))
    return of_members.withColumn("k", F.lit(1)).join(of_clusters.withColumn("k", F.lit(1)), "k").drop("k")


@query("user_graph_of_pairs", ["pairs"], """
    SELECT least(user_id_a, user_id_b) AS user_a, greatest(user_id_a, user_id_b) AS user_b,
           count(DISTINCT business_id) AS weight FROM pairs GROUP BY 1, 2""")
def user_graph_of_pairs(i):
    """The same graph from the list of review pairs."""
    return graph.user_graph(i.edges())


# ---- cases and business scores ------------------------------------------------------------------

@query("suspicious_cases_min_users", ["susbiz"], "SELECT * FROM susbiz WHERE suspicious_user_count >= 2",
       SUSBIZ_DOUBLES)
def suspicious_cases_min_users(i):
    return authenticity.suspicious_cases(i.suspicious_businesses(), 2)


@query("cases_with_names", ["cases"], "SELECT * FROM cases", SUSBIZ_DOUBLES)
def cases_with_names(i):
    return i.cases()


@query("cases_with_impact", ["cases_impact"], "SELECT * FROM cases_impact", CASE_IMPACT_DOUBLES)
def cases_with_impact(i):
    return authenticity.with_impact(i.cases(), i.rating())


@query("top_cases", ["cases_impact"], """
    SELECT name, business_id, spike_date, suspicious_user_count, suspicious_reviews_in_window, review_count,
           delta_after_before, avg_stars_before, avg_stars_during, avg_stars_after
    FROM cases_impact ORDER BY suspicious_user_count DESC NULLS LAST, delta_after_before DESC NULLS LAST,
         business_id, spike_date LIMIT 25""", ["delta_after_before", *STAR_DOUBLES])
def top_cases(i):
    return authenticity.top_cases(i.cases(), i.rating())


@query("case_labels", ["cases_impact"], """
    SELECT business_id, spike_date, concat(trim(name), ' | ', business_id, ' | ', strftime(spike_date, '%Y-%m-%d'),
           ' | susp_users=', suspicious_user_count, ' | Δ=',
           CASE WHEN delta_after_before IS NULL THEN 'nan' ELSE printf('%.2f', delta_after_before) END) AS label
    FROM cases_impact""")
def case_labels(i):
    return authenticity.case_labels(i.cases(), i.rating())


@query("business_labels", ["cases"], """
    SELECT DISTINCT business_id, concat(name, ' · ', business_id) AS label FROM cases""")
def business_labels(i):
    return authenticity.business_labels(i.cases())


@query("distinct_restaurant_names", ["names"], "SELECT DISTINCT name FROM names ORDER BY name")
def distinct_restaurant_names(i):
    return authenticity.distinct_names(i.names())


@query("business_spike_events", ["cases"], """
    SELECT business_id, spike_date, review_count, baseline_mean, abs_increase, total_reviews_in_window,
           suspicious_reviews_in_window, suspicious_user_count, max_anomaly_score FROM cases ORDER BY 1, 2""",
       ["baseline_mean", "abs_increase", "max_anomaly_score"])
def business_spike_events(i):
    return authenticity.business_spike_events(i.cases())


@query("business_flagged_reviewers", ["reviewers"], "SELECT * FROM reviewers")
def business_flagged_reviewers(i):
    return authenticity.flagged_reviewers(i.reviews(), i.flags())


@query("business_authenticity", ["restaurants", "cases", "impact", "reviewers", "clusters"], """
    SELECT *, 20 * has_spike_case + 20 * has_flagged_users + 40 * has_cluster + 20 * has_rating_change AS authenticity_score,
           CASE WHEN 20 * has_spike_case + 20 * has_flagged_users + 40 * has_cluster + 20 * has_rating_change >= 50
                THEN 1 ELSE 0 END AS is_suspicious
    FROM (
        SELECT b.business_id,
               CASE WHEN EXISTS (SELECT 1 FROM cases c WHERE c.business_id = b.business_id) THEN 1 ELSE 0 END AS has_spike_case,
               CASE WHEN (SELECT sum(suspicious_user_count) FROM cases c WHERE c.business_id = b.business_id) > 0 THEN 1 ELSE 0 END AS has_flagged_users,
               CASE WHEN EXISTS (SELECT 1 FROM reviewers r JOIN clusters k ON r.user_id = k.user_id
                                 WHERE r.business_id = b.business_id) THEN 1 ELSE 0 END AS has_cluster,
               CASE WHEN (SELECT max(abs(delta_after_before)) FROM impact i WHERE i.business_id = b.business_id) > 0.3 THEN 1 ELSE 0 END AS has_rating_change
        FROM restaurants b)""")
def business_authenticity(i):
    return authenticity.business_authenticity(
        i.restaurants(), i.narrow_reviews(), i.cases(), i.rating(), i.flags(), i.clusters())


@query("business_card", ["restaurants", "cases", "reviewers", "clusters"], """
    SELECT b.business_id, coalesce(c.n, 0) AS review_spikes, CAST(coalesce(c.u, 0) AS BIGINT) AS suspicious_users,
           coalesce(k.n, 0) AS review_farm_clusters
    FROM restaurants b
    LEFT JOIN (SELECT business_id, count(*) AS n, sum(suspicious_user_count) AS u FROM cases GROUP BY 1) c
      ON b.business_id = c.business_id
    LEFT JOIN (SELECT business_id, count(DISTINCT cluster_id) AS n FROM reviewers r JOIN clusters x
               ON r.user_id = x.user_id GROUP BY 1) k ON b.business_id = k.business_id""")
def business_card(i):
    return authenticity.business_card(
        i.restaurants(), i.narrow_reviews(), i.cases(), i.flags(), i.clusters())


@query("max_delta_event", ["impact"], """
    SELECT business_id, spike_date, avg_stars_before, avg_stars_during, avg_stars_after, delta_after_before
    FROM (SELECT *, row_number() OVER (PARTITION BY business_id
                 ORDER BY abs(delta_after_before) DESC NULLS LAST, spike_date) AS place FROM impact) WHERE place = 1""",
       [*STAR_DOUBLES, "delta_after_before"])
def max_delta_event(i):
    return authenticity.max_delta_event(i.rating())


@query("impact_by_period", ["rating"], """
    SELECT business_id, spike_date, 'Before' AS period, avg_stars_before AS avg_stars FROM rating
    UNION ALL SELECT business_id, spike_date, 'During', avg_stars_during FROM rating
    UNION ALL SELECT business_id, spike_date, 'After', avg_stars_after FROM rating""", ["avg_stars"])
def impact_by_period(i):
    return authenticity.impact_by_period(i.rating())


@query("users_vs_delta", ["cases", "deltas"], """
    SELECT c.business_id, c.spike_date, name, c.suspicious_user_count, c.suspicious_reviews_in_window, delta_after_before
    FROM cases c JOIN deltas d ON c.business_id = d.business_id AND c.spike_date = d.spike_date""",
       ["delta_after_before"])
def users_vs_delta(i):
    return authenticity.users_vs_delta(i.cases(), i.rating())


def _opened(df: DataFrame) -> DataFrame:
    """The business record as plain columns, for comparing engines."""
    return df.select(*[c for c in df.columns if c != "business"],
                     *[F.col(f"business.{c}").alias(f"business_{c}") for c in BUSINESS_INFO_COLUMNS])


OPENED_SQL = ", ".join(f"r.{c} AS business_{c}" for c in BUSINESS_INFO_COLUMNS)


@query("enrich_business", ["susbiz", "restaurants"], f"""
    SELECT s.*, {OPENED_SQL}
    FROM susbiz s LEFT JOIN restaurants r ON s.business_id = r.business_id""", SUSBIZ_DOUBLES)
def enrich_business(i):
    return _opened(authenticity.enrich_business(i.suspicious_businesses(), i.restaurants()))


@query("business_impact", ["volume", "impact"], """
    SELECT coalesce(v.business_id, i.business_id) AS business_id, coalesce(v.spike_date, i.spike_date) AS spike_date,
           v.* EXCLUDE (business_id, spike_date), i.window_days AS window_days_rating, i.review_count,
           i.baseline_mean AS baseline_mean_rating, i.baseline_std, i.history_days, i.abs_increase AS abs_increase_rating,
           i.z_score AS z_score_rating, i.total_reviews_in_window,
           i.suspicious_reviews_in_window AS suspicious_reviews_in_window_rating,
           i.suspicious_user_count AS suspicious_user_count_rating, i.max_anomaly_score, i.avg_anomaly_score,
           avg_stars_before, n_reviews_before, avg_stars_during, n_reviews_during, avg_stars_after, n_reviews_after,
           before_days, during_days, after_days, delta_after_before AS rating_change
    FROM (SELECT * FROM volume WHERE meaningful_increase_flag = 1) v
    FULL JOIN (SELECT * FROM impact WHERE abs(delta_after_before) > 0.3) i
      ON v.business_id = i.business_id AND v.spike_date = i.spike_date""",
       [*VOLUME_DOUBLES, "baseline_std", "baseline_mean_rating", "abs_increase_rating", "z_score_rating",
        "max_anomaly_score", "avg_anomaly_score", *STAR_DOUBLES, "rating_change"])
def business_impact(i):
    """Volume of the meaningful events against rating of the changed ones: either side has events that the other lacks."""
    volume = i.volume().filter("meaningful_increase_flag = 1")
    rating = i.rating().filter("abs(avg_stars_after - avg_stars_before) > 0.3")
    return authenticity.business_impact(volume, rating)


# ---- reports ------------------------------------------------------------------------------------

def _profile_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
               CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_cont({c}::DOUBLE, 0.25) AS DOUBLE) AS q25,
               CAST(quantile_cont({c}::DOUBLE, 0.5) AS DOUBLE) AS median,
               CAST(quantile_cont({c}::DOUBLE, 0.75) AS DOUBLE) AS q75, CAST(max({c}) AS DOUBLE) AS max
        FROM {table}""" for c in columns)


PROFILE_DOUBLES = ["mean", "std", "min", "q25", "median", "q75", "max"]
MEANINGFUL_PROFILE_COLUMNS = [*reports.VOLUME_PROFILE_COLUMNS, "suspicious_user_count"]


@query("profile_volume_impact", ["volume"], _profile_sql("volume", reports.VOLUME_PROFILE_COLUMNS), PROFILE_DOUBLES)
def profile_volume_impact(i):
    return reports.profile(i.once("volume", i.volume), reports.VOLUME_PROFILE_COLUMNS)


@query("profile_meaningful_events", ["volume"], _profile_sql(
    "(SELECT * FROM volume WHERE meaningful_increase_flag = 1)", MEANINGFUL_PROFILE_COLUMNS), PROFILE_DOUBLES)
def profile_meaningful_events(i):
    return reports.profile(reports.meaningful_events(i.once("volume", i.volume)), MEANINGFUL_PROFILE_COLUMNS)


@query("profile_anomalies", ["scores"], _profile_sql(
    "(SELECT * FROM scores WHERE is_anomaly = 1)", reports.ANOMALY_PROFILE_COLUMNS), PROFILE_DOUBLES)
def profile_anomalies(i):
    return reports.profile(i.once("scores", i.scores).filter("is_anomaly = 1"), reports.ANOMALY_PROFILE_COLUMNS)


@query("key_uniqueness", ["rr"], """
    SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_ids,
           count(*) - count(DISTINCT user_id) AS duplicate_ids FROM rr""")
def key_uniqueness(i):
    return reports.key_uniqueness(i.reviews(), "user_id")


@query("missingness", ["features"], "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        round((count(*) - count({c})) / count(*)::DOUBLE * 100, 6) AS missing_pct FROM features"""
    for c in ["user_id", *FEATURE_COLUMNS]))
def missingness(i):
    return reports.missingness(i.features())


def _correlation_sql(columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM scores"
        for a in columns for b in columns)


SHORT_CORRELATION = ["anomaly_score", "num_friends", "reviews_per_day", "review_count"]


@query("feature_correlation", ["scores"], _correlation_sql(reports.CORRELATION_COLUMNS), ["correlation"])
def feature_correlation(i):
    return reports.feature_correlation(i.scores())


@query("score_correlation", ["scores"], f"""
    SELECT * FROM ({_correlation_sql(SHORT_CORRELATION)}) WHERE column_a = 'anomaly_score'""", ["correlation"])
def score_correlation(i):
    return reports.correlation_with(i.scores(), "anomaly_score", SHORT_CORRELATION)


@query("volume_label_counts", ["volume"], """
    SELECT 'volume_change_label' AS report, volume_change_label AS value, count(*) AS events FROM volume GROUP BY 2
    UNION ALL SELECT 'meaningful_increase_flag', CAST(meaningful_increase_flag AS VARCHAR), count(*) FROM volume GROUP BY 2
    UNION ALL SELECT 'has_suspicious_users', CAST(has_suspicious_users AS VARCHAR), count(*) FROM volume GROUP BY 2""")
def volume_label_counts(i):
    return reports.volume_label_counts(i.volume())


@query("volume_kpis", ["volume"], """
    SELECT count(*) AS total_events, count(*) FILTER (WHERE volume_change_label = 'increased') AS increased,
           count(*) FILTER (WHERE volume_change_label = 'decreased') AS decreased,
           CAST(sum(meaningful_increase_flag) AS BIGINT) AS meaningful,
           CAST(sum(has_suspicious_users) AS BIGINT) AS with_suspicious_users,
           avg(reviews_before_spike) AS mean_before, avg(reviews_after_spike) AS mean_after,
           CAST(median(after_before_pct_change) AS DOUBLE) AS median_pct_change FROM volume""",
       ["mean_before", "mean_after", "median_pct_change"])
def volume_kpis(i):
    return reports.volume_kpis(i.once("volume", i.volume))


@query("delta_kpis", ["deltas", "cases"], """
    SELECT count(*) AS events, median(delta_after_before) AS median_delta, avg(delta_after_before) AS mean_delta,
           min(delta_after_before) AS min_delta, max(delta_after_before) AS max_delta,
           (SELECT count(*) FROM cases c JOIN deltas d ON c.business_id = d.business_id AND c.spike_date = d.spike_date) AS joined_points
    FROM deltas""", ["median_delta", "mean_delta", "min_delta", "max_delta"])
def delta_kpis(i):
    return reports.delta_kpis(i.once("rating", i.rating), i.cases())


@query("overview_kpis", ["susbiz", "impact"], """
    SELECT count(*) AS spike_days, count(*) FILTER (WHERE suspicious_user_count > 0) AS spike_days_with_suspicious_users,
           count(DISTINCT CASE WHEN suspicious_user_count > 0 THEN business_id END) AS unique_suspicious_businesses,
           (SELECT count(*) FROM impact) AS impact_events FROM susbiz""")
def overview_kpis(i):
    return reports.overview_kpis(i.suspicious_businesses(), i.rating())


def _histogram_sql(bins: int, index: str, below: float = 0.0) -> str:
    return f"""
        SELECT {bins} AS bins, CAST(b.bin AS INTEGER) AS bin,
               lo + b.bin * width - CASE WHEN b.bin = 0 THEN width * {bins} * {below} ELSE 0 END AS bin_start,
               lo + (b.bin + 1) * width AS bin_end, count(d) AS events
        FROM (SELECT min(delta_after_before) AS lo, (max(delta_after_before) - min(delta_after_before)) / {bins} AS width
              FROM deltas) CROSS JOIN range({bins}) b(bin)
        LEFT JOIN (SELECT delta_after_before AS d, least(greatest({index}, 0), {bins - 1}) AS place
                   FROM deltas, (SELECT min(delta_after_before) AS lo2,
                   (max(delta_after_before) - min(delta_after_before)) / {bins} AS width2 FROM deltas)) ON place = b.bin
        GROUP BY b.bin, lo, width"""


@query("delta_histogram", ["deltas"],
       _histogram_sql(44, "floor((delta_after_before - lo2) / width2)") + " UNION ALL "
       + _histogram_sql(24, "ceil((delta_after_before - lo2) / width2) - 1", 0.001), ["bin_start", "bin_end"])
def delta_histogram(i):
    return reports.delta_histogram(i.once("rating", i.rating))


@query("delta_box", ["deltas"], """
    WITH q AS (SELECT quantile_cont(delta_after_before, 0.25) AS q1, quantile_cont(delta_after_before, 0.5) AS median,
                      quantile_cont(delta_after_before, 0.75) AS q3 FROM deltas),
         m AS (SELECT d.delta_after_before AS d, q.*, delta_after_before BETWEEN q1 - 1.5 * (q3 - q1)
                      AND q3 + 1.5 * (q3 - q1) AS inside FROM deltas d CROSS JOIN q)
    SELECT any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
           min(d) FILTER (WHERE inside) AS lower_whisker, max(d) FILTER (WHERE inside) AS upper_whisker,
           count(*) FILTER (WHERE NOT inside) AS outliers FROM m""",
       ["q1", "median", "q3", "lower_whisker", "upper_whisker"])
def delta_box(i):
    return reports.delta_box(i.once("rating", i.rating))


@query("median_impute", ["features"], f"""
    WITH m AS (SELECT {", ".join(f"median({c})::DOUBLE AS {c}" for c in FEATURE_COLUMNS)} FROM features)
    SELECT user_id, {", ".join(f"coalesce(f.{c}::DOUBLE, m.{c}, 0) AS {c}" for c in FEATURE_COLUMNS)}
    FROM features f CROSS JOIN m""", FEATURE_COLUMNS)
def median_impute(i):
    return forest.median_impute(i.once("features", i.features))


# ---- ranked lists -------------------------------------------------------------------------------

EVENT_ORDER = "business_id, spike_date"


def _top_volume(order: str, limit: int, where: str = "TRUE", columns: str = "*") -> str:
    return f"SELECT {columns} FROM volume WHERE {where} ORDER BY {order}, {EVENT_ORDER} LIMIT {limit}"


@query("top_volume_events", ["volume"],
       _top_volume("spike_day_review_count DESC, suspicious_reviews_in_window DESC", 20), VOLUME_DOUBLES)
def top_volume_events(i):
    return reports.top_volume_events(i.volume())


@query("top_suspicious_businesses", ["susbiz", "restaurants"], f"""
    WITH ranked AS (SELECT *, row_number() OVER (ORDER BY round(z_score, 6) DESC NULLS LAST,
                    suspicious_user_count DESC NULLS LAST, business_id, spike_date) AS place FROM susbiz)
    SELECT s.* EXCLUDE (place), {OPENED_SQL}
    FROM ranked s LEFT JOIN restaurants r ON s.business_id = r.business_id WHERE place <= 50""", SUSBIZ_DOUBLES)
def top_suspicious_businesses(i):
    # Ordered by the rounded score: the last bits of a deviation differ between engines.
    top = reports.top_suspicious_businesses(rounded(i.suspicious_businesses()))
    return _opened(authenticity.enrich_business(top, i.restaurants()))


@query("volume_increases", ["volume"], _top_volume(
    "after_minus_before DESC", 5, "after_minus_before > 0", _columns(reports.CHANGE_COLUMNS)),
    ["after_before_pct_change"])
def volume_increases(i):
    return reports.volume_increases(i.volume())


@query("volume_decreases", ["volume"], _top_volume(
    "after_minus_before", 5, "after_minus_before < 0", _columns(reports.CHANGE_COLUMNS)),
    ["after_before_pct_change"])
def volume_decreases(i):
    return reports.volume_decreases(i.volume())


@query("growth_cases", ["volume"], _top_volume(
    "after_before_pct_change DESC NULLS LAST", 10,
    "volume_change_label = 'increased' AND meaningful_increase_flag = 1"), VOLUME_DOUBLES)
def growth_cases(i):
    return reports.growth_cases(i.volume())


@query("suspicious_user_cases", ["volume"], _top_volume(
    "suspicious_user_count DESC", 10, "has_suspicious_users = 1"), VOLUME_DOUBLES)
def suspicious_user_cases(i):
    return reports.suspicious_user_cases(i.volume())


@query("meaningful_events", ["volume"], "SELECT * FROM volume WHERE meaningful_increase_flag = 1", VOLUME_DOUBLES)
def meaningful_events(i):
    return reports.meaningful_events(i.volume())


@query("volume_case_studies", ["volume", "restaurants"], """
    SELECT v.*, name, city, state, categories FROM volume v LEFT JOIN restaurants r ON v.business_id = r.business_id""",
       VOLUME_DOUBLES)
def volume_case_studies(i):
    return reports.volume_case_studies(i.volume(), i.restaurants())


@query("strong_cases", ["volume", "restaurants"], f"""
    SELECT {_columns(["v.business_id", "name", *reports.STRONG_COLUMNS[2:]])}
    FROM volume v LEFT JOIN restaurants r ON v.business_id = r.business_id
    WHERE has_suspicious_users = 1 AND meaningful_increase_flag = 1
    ORDER BY suspicious_user_count DESC, after_minus_before DESC, v.business_id, spike_date LIMIT 10""",
       ["after_before_pct_change", "suspicious_review_share"])
def strong_cases(i):
    return reports.strong_cases(i.volume(), i.restaurants())


@query("global_rank", ["stats"], """
    SELECT user_id, review_count, row_number() OVER (ORDER BY review_count DESC, user_id) AS rank FROM stats""")
def global_rank(i):
    counts = i.once("counts", lambda: features.user_review_stats(i.reviews()).select("user_id", "review_count"))
    return global_row_number(counts, [F.desc("review_count"), F.col("user_id")], "rank")


# ---- reports over scored users, with the stand-in scores so that they have an exact oracle -------

def _top_scores(where: str, limit: int, columns: str = "* EXCLUDE (anomaly_rank)") -> str:
    return (f"SELECT {columns} FROM scores WHERE is_anomaly = 1 AND ({where})"
            f" ORDER BY anomaly_score DESC, user_id LIMIT {limit}")


SCORED_DOUBLES = [*FEATURE_DOUBLES, "anomaly_score"]


@query("anomaly_rank", ["scores"], "SELECT * FROM scores", SCORED_DOUBLES)
def anomaly_rank(i):
    return i.ranked_scores()


@query("top_suspicious_users", ["scores"], """
    SELECT * FROM scores WHERE is_anomaly = 1 ORDER BY anomaly_rank LIMIT 50""", SCORED_DOUBLES)
def top_suspicious_users(i):
    return reports.top_suspicious_users(i.ranked_scores())


@query("anomaly_rank_top5", ["scores"], f"""
    SELECT {_columns(reports.RANK_COLUMNS)} FROM scores WHERE anomaly_rank <= 5""", ["reviews_per_day", "anomaly_score"])
def anomaly_rank_top5(i):
    return reports.anomaly_rank_top(i.ranked_scores())


@query("anomaly_bots", ["scores"], _top_scores("num_friends = 0", 10), SCORED_DOUBLES)
def anomaly_bots(i):
    return reports.anomaly_bots(i.scores())


@query("anomaly_bombers", ["scores"], _top_scores(f"reviews_per_day > {BOMBER_RATE}", 10), SCORED_DOUBLES)
def anomaly_bombers(i):
    return reports.anomaly_bombers(i.scores(), min_per_day=BOMBER_RATE)


@query("anomaly_rating_extremes", ["scores"], f"""
    SELECT * FROM ({_top_scores("avg_stars_given >= 4.5", 10, _columns(reports.RATING_COLUMNS) + ", 'high' AS side")})
    UNION ALL
    SELECT * FROM ({_top_scores("avg_stars_given <= 1.5", 10, _columns(reports.RATING_COLUMNS) + ", 'low' AS side")})""",
       ["avg_stars_given", "reviews_per_day"])
def anomaly_rating_extremes(i):
    return reports.anomaly_rating_extremes(i.once("scores", i.scores))


@query("anomaly_pct_extremes", ["scores"], _top_scores(
    "pct_5_star_reviews > 0.95 OR pct_1_star_reviews > 0.95", 10), SCORED_DOUBLES)
def anomaly_pct_extremes(i):
    return reports.anomaly_pct_extremes(i.scores())


@query("zero_friend_counts", ["scores"], """
    SELECT count(*) AS anomalies, count(*) FILTER (WHERE num_friends = 0) AS zero_friend_anomalies,
           (SELECT count(*) FILTER (WHERE num_friends = 0) FROM (SELECT num_friends FROM scores WHERE is_anomaly = 1
            ORDER BY anomaly_score DESC, user_id LIMIT 500)) AS zero_friend_top
    FROM scores WHERE is_anomaly = 1""")
def zero_friend_counts(i):
    return reports.zero_friend_counts(i.once("scores", i.scores))


@query("score_metrics", ["scores"], """
    SELECT count(*) AS n_users_scored, CAST(sum(is_anomaly) AS BIGINT) AS n_anomalies, avg(is_anomaly) AS anomaly_rate,
           avg(anomaly_score) AS anomaly_score_mean, stddev_pop(anomaly_score) AS anomaly_score_std,
           max(anomaly_score) AS anomaly_score_max, min(anomaly_score) AS anomaly_score_min FROM scores""",
       ["anomaly_rate", "anomaly_score_mean", "anomaly_score_std", "anomaly_score_max", "anomaly_score_min"])
def score_metrics(i):
    return forest.score_metrics(i.scores())


@query("friends_vs_score", ["scores"], "SELECT num_friends, anomaly_score, is_anomaly FROM scores", ["anomaly_score"])
def friends_vs_score(i):
    return reports.friends_vs_score(i.scores())


# ---- isolation forest: no SQL form, checked by the invariants in tests ---------------------------

@query("iforest_trees")
def iforest_trees(i):
    return forest.grow_trees(forest.model_input(i.once("features", i.features)), forest.SWEEP)


@query("user_anomaly_scores")
def user_anomaly_scores(i):
    return i.model_scores()


@query("model_invariants", ["scores"], """
    SELECT count(*) AS users, count(*) - 1 - CAST(floor(0.95 * (count(*) - 1)) AS BIGINT) AS flagged, 1 AS lowest_rank,
           count(*) AS highest_rank, count(*) AS ranks, 0 AS out_of_order FROM scores""")
def model_invariants(i):
    """Ranks are a permutation in the order of the scores, and the highest twentieth is flagged."""
    scores = stored(i.model_scores().select("anomaly_rank", "anomaly_score", "is_anomaly"), "ranked")
    ahead = scores.select((F.col("anomaly_rank") + 1).alias("anomaly_rank"), F.col("anomaly_score").alias("before"))
    return scores.join(ahead, "anomaly_rank", "left").agg(
        F.count(F.lit(1)).alias("users"), F.count_if(F.expr("is_anomaly = 1")).alias("flagged"), F.min("anomaly_rank").alias("lowest_rank"),
        F.max("anomaly_rank").alias("highest_rank"), F.countDistinct("anomaly_rank").alias("ranks"),
        F.count_if(F.expr("anomaly_score > before")).alias("out_of_order"))


@query("tree_invariants", ["scores"], """
    SELECT config, 300 AS trees, CAST(least(256, (SELECT count(*) FROM scores)) AS BIGINT) AS smallest_root,
           CAST(least(256, (SELECT count(*) FROM scores)) AS BIGINT) AS largest_root, 0 AS too_deep,
           300 * least(256, (SELECT count(*) FROM scores)) AS rows_in_leaves
    FROM (VALUES ('full_features'), ('subsampled_features')) t(config)""")
def tree_invariants(i):
    """Every configuration has its trees, every tree a full sample, no leaf is too deep, and leaves hold all rows."""
    nodes = forest.grow_trees(forest.model_input(i.once("features", i.features)), forest.SWEEP)
    root = F.when(F.col("node_id") == 0, F.col("size").cast("long"))
    return nodes.groupBy("config").agg(
        F.count_distinct("tree_id").alias("trees"), F.min(root).alias("smallest_root"), F.max(root).alias("largest_root"),
        F.count_if(F.col("depth") > 8).alias("too_deep"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("rows_in_leaves"))


@query("model_score_metrics")
def model_score_metrics(i):
    return forest.score_metrics(i.model_scores())


@query("model_top_users")
def model_top_users(i):
    return reports.top_suspicious_users(i.model_scores())


@query("model_zero_friend_counts")
def model_zero_friend_counts(i):
    return reports.zero_friend_counts(i.once("model-scores", i.model_scores))


SMALL_FOREST = [forest.ForestConfig("small", 0.05, 10, 1.0, 42, 16), forest.ForestConfig("small_half", 0.05, 10, 0.5, 7, 16)]


def _small_forest_sql(last: str, depth: int = 4) -> str:
    """Growth written out level by level: samples of 16 rows reach depth 4."""
    names = {c.name: f"{c.name}:{c.seed}" for c in SMALL_FOREST}
    usable = {c.name: max(1, int(c.max_features * len(FEATURE_COLUMNS))) for c in SMALL_FOREST}

    def u(*salt: str) -> str:
        return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(salt)})), 1, 13) AS BIGINT) / {float(1 << 52)}"

    configs = ", ".join(f"('{n}', '{names[n]}', {usable[n]})" for n in names)
    filled = ", ".join(f"coalesce(f.{c}::DOUBLE, m.{c}, 0)" for c in FEATURE_COLUMNS)
    parts = [f"""
    m AS (SELECT {", ".join(f"median({c})::DOUBLE AS {c}" for c in FEATURE_COLUMNS)} FROM features
          WHERE num_friends IS NOT NULL AND account_age_days IS NOT NULL),
    input AS MATERIALIZED (SELECT user_id, [{filled}] AS x FROM features f CROSS JOIN m
          WHERE f.num_friends IS NOT NULL AND f.account_age_days IS NOT NULL),
    configs(config, salt, n_usable) AS (VALUES {configs}),
    rolled AS (
      SELECT config, salt, n_usable, tree_id, x, user_id, {u("salt", "'row'", "tree_id", "user_id")} AS roll
      FROM input, configs, range(0, {SMALL_FOREST[0].n_estimators}) AS t(tree_id)),
    picked AS MATERIALIZED (
      SELECT * FROM rolled
      QUALIFY row_number() OVER (PARTITION BY config, tree_id ORDER BY roll, user_id) <= {SMALL_FOREST[0].max_samples}),
    chosen AS MATERIALIZED (
      SELECT config, tree_id, i FROM (
        SELECT config, tree_id, i, n_usable, row_number() OVER (
          PARTITION BY config, tree_id ORDER BY {u("salt", "'feature'", "tree_id", "i")}, i) AS r
        FROM configs, range(0, {SMALL_FOREST[0].n_estimators}) AS t(tree_id), range(0, {len(FEATURE_COLUMNS)}) AS f(i))
      WHERE r <= n_usable),
    rows_0 AS (SELECT config, salt, tree_id, x, 1::BIGINT AS node_id FROM picked)"""]
    for d in range(depth + 1):
        parts.append(f"""
    size_{d} AS MATERIALIZED (SELECT config, salt, tree_id, node_id, count(*) AS size FROM rows_{d} GROUP BY ALL),
    cut_{d} AS MATERIALIZED (
      SELECT * FROM (
        SELECT r.config, r.salt, r.tree_id, node_id, i, min(x[i + 1]) AS low, max(x[i + 1]) AS high
        FROM rows_{d} r JOIN chosen USING (config, tree_id) GROUP BY ALL)
      WHERE low < high AND {d} < {depth}
      QUALIFY row_number() OVER (PARTITION BY config, tree_id, node_id
                                 ORDER BY {u("salt", "'cut'", "tree_id", "node_id", "i")}, i) = 1),
    at_{d} AS (SELECT *, low + {u("salt", "'at'", "tree_id", "node_id")} * (high - low) AS t FROM cut_{d}),
    nodes_{d} AS MATERIALIZED (
      SELECT s.config, s.tree_id, s.node_id, coalesce(i, -1) AS feature,
             CASE WHEN t < high THEN t ELSE low END AS threshold, size, {d} AS depth
      FROM size_{d} s LEFT JOIN at_{d} USING (config, tree_id, node_id)),
    rows_{d + 1} AS MATERIALIZED (
      SELECT config, salt, tree_id, x, 2 * node_id + CAST(x[feature + 1] > threshold AS BIGINT) AS node_id
      FROM rows_{d} JOIN nodes_{d} USING (config, tree_id, node_id) WHERE feature >= 0)""")
    parts.append("\n    nodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM nodes_{d}" for d in range(depth + 1)) + ")")
    step = "LEFT JOIN nodes n{d} ON n{d}.config = w.config AND n{d}.tree_id = w.tree_id AND n{d}.node_id = w.node_{d}"
    parts.append("""
    walk_0 AS (SELECT user_id, x, config, tree_id, 1::BIGINT AS node_id
               FROM input, configs, range(0, 10) AS t(tree_id))""")
    for d in range(depth):
        parts.append(f"""
    walk_{d + 1} AS (
      SELECT w.user_id, w.x, w.config, w.tree_id,
             CASE WHEN feature < 0 THEN w.node_id ELSE 2 * w.node_id + CAST(x[feature + 1] > threshold AS BIGINT) END AS node_id
      FROM walk_{d} w JOIN nodes USING (config, tree_id, node_id))""")
    mean = "CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    parts.append(f"""
    raw AS MATERIALIZED (
      SELECT config, user_id, pow(2.0, -(sum(depth + {mean.format(n="size")}) / 10) / max(norm)) AS raw_score
      FROM walk_{depth} JOIN nodes USING (config, tree_id, node_id)
      JOIN (SELECT config, max({mean.format(n="size")}) AS norm FROM nodes WHERE node_id = 1 GROUP BY config) USING (config)
      GROUP BY config, user_id),
    scored AS (
      SELECT config, user_id, raw_score - cut AS anomaly_score, CASE WHEN raw_score > cut THEN 1 ELSE 0 END AS is_anomaly,
             row_number() OVER (PARTITION BY config ORDER BY round(raw_score, 9) DESC, user_id) AS anomaly_rank
      FROM raw JOIN (SELECT config, quantile_cont(raw_score, 0.95) AS cut FROM raw GROUP BY config) USING (config))""")
    return "SELECT * FROM (WITH " + ",".join(parts) + last + ")"


def _small_forest(i) -> DataFrame:
    return level_forest.grown(i.once("model-input", lambda: forest.model_input(i.once("features", i.features))), SMALL_FOREST)


def _small_scores(i, config: forest.ForestConfig) -> DataFrame:
    """Scores, flags and ranks by the level-wise forest; equal scores are equal to nine digits."""
    data, nodes = i.once("model-input", lambda: forest.model_input(i.once("features", i.features))), i.once("nodes", lambda: _small_forest(i))
    raw = stored(level_forest.raw_scores(data, nodes, config).select(
        "user_id", "raw_score", F.round("raw_score", 9).alias("near")), "raw-scores")
    ranked = global_row_number(raw, [F.desc("near"), F.col("user_id")], "_rank")
    return forest.flag_scores(ranked, config.contamination).select(
        F.lit(config.name).alias("config"), "user_id", "anomaly_score", "is_anomaly", F.col("_rank").alias("anomaly_rank"))


@query("small_forest_trees", ["features"], _small_forest_sql("\n    SELECT * FROM nodes"), ["threshold"])
def small_forest_trees(i):
    """Trees of two small configurations, node by node."""
    return _small_forest(i)


@query("small_forest_scores", ["features"], _small_forest_sql("""
    SELECT user_id, anomaly_score, is_anomaly, anomaly_rank, anomaly_rank AS output_place FROM scored WHERE config = 'small'"""),
       ["anomaly_score"])
def small_forest_scores(i):
    """Score, flag and rank of every complete user, and each one's place in the ordered output."""
    ordered = _small_scores(i, SMALL_FOREST[0]).drop("config").orderBy("anomaly_rank").withColumn("_at", F.monotonically_increasing_id())
    return global_row_number(stored(ordered, "ordered"), [F.col("_at")], "output_place").drop("_at")


@query("small_forest_sweep", ["features"], _small_forest_sql("""
    SELECT config, stddev_pop(anomaly_score) AS score_std, sum(is_anomaly) AS n_anomalies, avg(anomaly_score) AS score_mean,
           max(anomaly_score) AS score_max FROM scored GROUP BY config"""), ["score_std", "score_mean", "score_max"])
def small_forest_sweep(i):
    """The configuration summary over the level-wise forest."""
    both = _small_scores(i, SMALL_FOREST[0]).unionByName(_small_scores(i, SMALL_FOREST[1])).withColumn("max_features", F.lit(0.0))
    return forest.anomaly_config_summary(both).drop("max_features")


@query("anomaly_config_summary")
def anomaly_config_summary(i):
    return forest.anomaly_config_summary(forest.config_scores(i.once("features", i.features)))


@query("full_chain_authenticity")
def full_chain_authenticity(i):
    """Model flags, spikes, graph, communities and impact up to the business score."""
    return analyse(views.reviews(i.spark, i.sf), views.raw_users(i.spark, i.sf),
                   i.businesses(), as_of=views.AS_OF, rule=views.TUNED_RULE)["business_authenticity"]
