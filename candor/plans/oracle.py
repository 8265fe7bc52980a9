"""Independent SQL for every query that SQL can express, for an embedded SQL engine.

Named table expressions are kept once with the names they build on;
``oracle`` puts those a query needs in front of it and rounds the doubles the
way the registry does.
"""

from __future__ import annotations

from candor.schemas import SIGNUP_COLUMN

AS_OF = "DATE '2002-01-01'"

# name -> (what it builds on, SQL)
TABLES: dict[str, tuple[list[str], str]] = {
    "reviews": ([], """
        SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))) AS review_id,
               CASE WHEN l_orderkey % 101 <> 0 THEN CASE WHEN o_custkey % 97 = 5 THEN -o_custkey ELSE o_custkey END END AS user_id,
               CASE WHEN l_orderkey % 103 <> 0 THEN l_suppkey // 5 END AS business_id,
               CASE WHEN o_custkey % 10 = 0 THEN 5.0::DOUBLE WHEN o_custkey % 10 = 1 THEN 1.0::DOUBLE
                    ELSE (1 + CAST(l_quantity AS INT) % 5)::DOUBLE END AS stars,
               CASE WHEN l_partkey % 50 = 0 THEN '   '
                    ELSE concat('  ', repeat(l_returnflag, CAST(l_quantity AS INT)), ' ') END AS text,
               l_shipdate + to_hours(CAST(3 * l_linenumber AS INT)) AS date,
               CAST(year(l_shipdate + to_hours(CAST(3 * l_linenumber AS INT))) AS INTEGER) AS review_year
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "users": ([], f"""
        SELECT c_custkey AS user_id,
               CASE WHEN c_custkey % 211 = 0 THEN 'bad'
                    ELSE strftime(TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey % 1500 AS INT)), '%Y-%m-%d %H:%M:%S') END AS {SIGNUP_COLUMN},
               CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None'
                    ELSE repeat('f, ', CAST(c_custkey % 9 AS INT)) || 'f' END AS friends
        FROM customer"""),
    "businesses": ([], """
        SELECT business_id, concat('Business ', business_id // 2) AS name, concat('City ', business_id % 3) AS city,
               concat('S', business_id % 3) AS state,
               CASE WHEN business_id % 8 = 7 THEN NULL ELSE CASE business_id % 4 WHEN 0 THEN 'Mexican, Restaurants'
                    WHEN 1 THEN 'restaurants, Bars' WHEN 2 THEN 'RESTAURANTS' ELSE 'Shopping' END END AS categories
        FROM (SELECT DISTINCT l_suppkey // 5 AS business_id FROM lineitem)"""),
    "flags": ([], """
        SELECT c_custkey AS user_id, CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END AS is_anomaly,
               (c_custkey % 97) / 1000.0::DOUBLE AS anomaly_score FROM customer"""),
    "clusters": (["flags"], "SELECT user_id, user_id % 7 AS cluster_id FROM flags WHERE is_anomaly = 1"),
    "restaurants": (["businesses"], """
        SELECT * FROM businesses WHERE business_id IS NOT NULL AND lower(categories) LIKE '%restaurants%'"""),
    "reviews_b": (["reviews"], """
        SELECT review_id, user_id, business_id, stars, trim(text) AS text, date, review_year FROM reviews
        WHERE user_id IS NOT NULL AND business_id IS NOT NULL AND length(trim(text)) > 0"""),
    "rr": (["reviews_b", "restaurants"], """
        SELECT * FROM reviews_b WHERE business_id IN (SELECT business_id FROM restaurants)"""),
    "users_b": (["users"], f"""
        SELECT user_id, try_cast({SIGNUP_COLUMN} AS TIMESTAMP) AS {SIGNUP_COLUMN}, friends
        FROM users WHERE user_id IS NOT NULL"""),
    "daily": (["rr"], """
        SELECT business_id, CAST(date AS DATE) AS review_date, count(*) AS review_count FROM rr
        WHERE date IS NOT NULL GROUP BY 1, 2"""),
    "base": (["daily"], """
        SELECT *, avg(review_count) OVER w AS baseline_mean, stddev_samp(review_count) OVER w AS baseline_std,
               count(*) OVER w AS history_days
        FROM daily WINDOW w AS (PARTITION BY business_id ORDER BY review_date
                                ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""),
    "spikes": (["base"], """
        SELECT business_id, review_date, review_count, baseline_mean, baseline_std, history_days,
               review_count - coalesce(baseline_mean, 0) AS abs_increase,
               CASE WHEN baseline_std > 0 THEN (review_count - coalesce(baseline_mean, 0)) / baseline_std END AS z_score,
               CASE WHEN history_days >= 30 AND review_count >= 4 AND review_count >= coalesce(baseline_mean, 0) * 2.0
                     AND review_count - coalesce(baseline_mean, 0) >= 3.0 THEN 1 ELSE 0 END AS is_spike
        FROM base"""),
    "spikes_default": (["base"], """
        SELECT business_id, review_date, review_count, baseline_mean, baseline_std, history_days,
               review_count - coalesce(baseline_mean, 0) AS abs_increase,
               CASE WHEN baseline_std > 0 THEN (review_count - coalesce(baseline_mean, 0)) / baseline_std END AS z_score,
               CASE WHEN history_days >= 30 AND review_count >= 5 AND review_count >= coalesce(baseline_mean, 0) * 3.0
                     AND review_count - coalesce(baseline_mean, 0) >= 5.0 THEN 1 ELSE 0 END AS is_spike
        FROM base"""),
    "events": (["spikes"], """
        SELECT business_id, review_date AS spike_date, review_count, baseline_mean, baseline_std, history_days,
               abs_increase, z_score FROM spikes WHERE is_spike = 1"""),
    "stats": (["rr"], """
        SELECT user_id, avg(stars) AS avg_stars_given,
               sum(CASE WHEN stars = 5 THEN 1 ELSE 0 END) / count(*)::DOUBLE AS pct_5_star_reviews,
               sum(CASE WHEN stars = 1 THEN 1 ELSE 0 END) / count(*)::DOUBLE AS pct_1_star_reviews,
               count(*) AS review_count
        FROM rr WHERE user_id IS NOT NULL AND stars IS NOT NULL GROUP BY user_id"""),
    "friends": (["users_b"], f"""
        SELECT user_id, CAST({AS_OF} - CAST({SIGNUP_COLUMN} AS DATE) AS INTEGER) AS account_age_days,
               CAST(CASE WHEN friends IS NULL OR trim(friends) = '' OR lower(trim(friends)) = 'none' THEN 0
                    ELSE len(regexp_split_to_array(trim(friends), '\\s*,\\s*')) END AS INTEGER) AS num_friends
        FROM users_b"""),
    "features": (["stats", "friends"], """
        SELECT s.user_id, avg_stars_given, pct_5_star_reviews, pct_1_star_reviews, review_count,
               CASE WHEN account_age_days > 0 THEN review_count / account_age_days::DOUBLE ELSE 0.0 END AS reviews_per_day,
               account_age_days, num_friends
        FROM stats s LEFT JOIN friends f ON s.user_id = f.user_id"""),
    "filled": (["features"], """
        SELECT user_id, coalesce(avg_stars_given, 0) AS avg_stars_given, coalesce(pct_5_star_reviews, 0) AS pct_5_star_reviews,
               coalesce(pct_1_star_reviews, 0) AS pct_1_star_reviews, coalesce(review_count, 0) AS review_count,
               coalesce(reviews_per_day, 0) AS reviews_per_day, coalesce(account_age_days, 0) AS account_age_days,
               coalesce(num_friends, 0) AS num_friends FROM features"""),
    "rule_flags": (["filled"], """
        SELECT *, CASE WHEN avg_stars_given <= 1.5 OR avg_stars_given >= 4.5 OR pct_5_star_reviews >= 0.9
                        OR pct_1_star_reviews >= 0.9 THEN 1 ELSE 0 END AS extreme_rating_flag,
               CASE WHEN (review_count >= 20 AND reviews_per_day >= 0.02)
                      OR (review_count >= 50 AND num_friends <= 1) THEN 1 ELSE 0 END AS review_burst_flag,
               CASE WHEN num_friends <= 1 AND review_count >= 10 THEN 1 ELSE 0 END AS low_friends_flag
        FROM filled"""),
    "rules": (["rule_flags"], """
        SELECT *, extreme_rating_flag + review_burst_flag + low_friends_flag AS flag_count,
               round((extreme_rating_flag + review_burst_flag + low_friends_flag) / 3.0::DOUBLE, 4) AS rule_based_score,
               CASE WHEN low_friends_flag = 1 AND (extreme_rating_flag = 1 OR review_burst_flag = 1) THEN 1 ELSE 0 END AS is_flagged_suspicious
        FROM rule_flags"""),
    "scores": (["features", "flags"], """
        SELECT f.*, anomaly_score, is_anomaly,
               row_number() OVER (ORDER BY anomaly_score DESC, f.user_id) AS anomaly_rank
        FROM features f JOIN flags g ON f.user_id = g.user_id
        WHERE account_age_days IS NOT NULL AND num_friends IS NOT NULL"""),
    "in_window": (["rr", "events"], """
        SELECT r.*, e.spike_date, CAST(r.date AS DATE) AS review_date FROM rr r JOIN events e
          ON r.business_id = e.business_id AND CAST(r.date AS DATE) = e.spike_date"""),
    "in_window3": (["rr", "events"], """
        SELECT r.*, e.spike_date, CAST(r.date AS DATE) AS review_date FROM rr r JOIN events e
          ON r.business_id = e.business_id
         AND CAST(r.date AS DATE) BETWEEN e.spike_date - 3 AND e.spike_date + 3"""),
    "flagged": (["flags"], "SELECT user_id, anomaly_score FROM flags WHERE is_anomaly = 1"),
    "sus_aggs": (["in_window", "flagged"], """
        SELECT business_id, spike_date, count(*) AS suspicious_reviews_in_window,
               count(DISTINCT w.user_id) AS suspicious_user_count, max(anomaly_score) AS max_anomaly_score,
               avg(anomaly_score) AS avg_anomaly_score
        FROM in_window w JOIN flagged f ON w.user_id = f.user_id GROUP BY 1, 2"""),
    "susbiz": (["events", "in_window", "sus_aggs"], """
        SELECT e.*, coalesce(t.n, 0) AS total_reviews_in_window,
               coalesce(s.suspicious_reviews_in_window, 0) AS suspicious_reviews_in_window,
               coalesce(s.suspicious_user_count, 0) AS suspicious_user_count,
               s.max_anomaly_score, s.avg_anomaly_score, 0 AS window_days
        FROM events e
        LEFT JOIN (SELECT business_id, spike_date, count(*) AS n FROM in_window GROUP BY 1, 2) t USING (business_id, spike_date)
        LEFT JOIN sus_aggs s USING (business_id, spike_date)"""),
    "rated": (["rr"], "SELECT business_id, CAST(date AS DATE) AS review_date, stars FROM rr WHERE stars IS NOT NULL"),
    "before": (["rated", "events"], """
        SELECT e.business_id, e.spike_date, avg(stars) AS avg_stars_before, count(*) AS n_reviews_before
        FROM rated r JOIN events e ON r.business_id = e.business_id
         AND r.review_date BETWEEN e.spike_date - 30 AND e.spike_date - 1 GROUP BY 1, 2"""),
    "during": (["rated", "events"], """
        SELECT e.business_id, e.spike_date, avg(stars) AS avg_stars_during, count(*) AS n_reviews_during
        FROM rated r JOIN events e ON r.business_id = e.business_id AND r.review_date = e.spike_date GROUP BY 1, 2"""),
    "during3": (["rated", "events"], """
        SELECT e.business_id, e.spike_date, avg(stars) AS avg_stars_during, count(*) AS n_reviews_during
        FROM rated r JOIN events e ON r.business_id = e.business_id
         AND r.review_date BETWEEN e.spike_date - 3 AND e.spike_date + 3 GROUP BY 1, 2"""),
    "after": (["rated", "events"], """
        SELECT e.business_id, e.spike_date, avg(stars) AS avg_stars_after, count(*) AS n_reviews_after
        FROM rated r JOIN events e ON r.business_id = e.business_id
         AND r.review_date BETWEEN e.spike_date + 1 AND e.spike_date + 30 GROUP BY 1, 2"""),
    "rating": (["susbiz", "before", "during", "after"], """
        SELECT s.*, avg_stars_before, n_reviews_before, avg_stars_during, n_reviews_during, avg_stars_after,
               n_reviews_after, 30 AS before_days, 0 AS during_days, 30 AS after_days
        FROM susbiz s LEFT JOIN before USING (business_id, spike_date) LEFT JOIN during USING (business_id, spike_date)
        LEFT JOIN after USING (business_id, spike_date)"""),
    "impact": (["rating"], "SELECT *, avg_stars_after - avg_stars_before AS delta_after_before FROM rating"),
    "deltas": (["impact"], "SELECT * FROM impact WHERE delta_after_before IS NOT NULL"),
    "vcounts": (["rr", "susbiz"], """
        SELECT s.business_id, s.spike_date,
               count(*) FILTER (WHERE CAST(r.date AS DATE) < s.spike_date) AS reviews_before_spike,
               count(*) FILTER (WHERE CAST(r.date AS DATE) = s.spike_date) AS reviews_on_spike_date,
               count(*) FILTER (WHERE CAST(r.date AS DATE) > s.spike_date) AS reviews_after_spike
        FROM rr r JOIN susbiz s ON r.business_id = s.business_id
         AND CAST(r.date AS DATE) BETWEEN s.spike_date - 30 AND s.spike_date + 30 GROUP BY 1, 2"""),
    "vchange": (["susbiz", "vcounts"], """
        SELECT s.*, reviews_before_spike, reviews_on_spike_date, reviews_after_spike,
               reviews_after_spike - reviews_before_spike AS after_minus_before,
               CASE WHEN reviews_before_spike > 0 THEN round((reviews_after_spike - reviews_before_spike)
                    / reviews_before_spike::DOUBLE * 100, 2) END AS after_before_pct_change,
               reviews_before_spike + reviews_on_spike_date + reviews_after_spike AS total_reviews_in_impact_window
        FROM susbiz s JOIN vcounts USING (business_id, spike_date)"""),
    "volume": (["vchange"], """
        SELECT business_id, spike_date, 30 AS window_days, review_count AS spike_day_review_count, baseline_mean,
               abs_increase, z_score, suspicious_reviews_in_window, suspicious_user_count,
               total_reviews_in_impact_window,
               CASE WHEN total_reviews_in_impact_window > 0 THEN round(suspicious_reviews_in_window
                    / total_reviews_in_impact_window::DOUBLE, 4) ELSE 0.0 END AS suspicious_review_share,
               CASE WHEN suspicious_user_count > 0 THEN 1 ELSE 0 END AS has_suspicious_users,
               reviews_before_spike, reviews_on_spike_date, reviews_after_spike, after_minus_before,
               after_before_pct_change,
               CASE WHEN after_minus_before > 0 THEN 'increased' WHEN after_minus_before < 0 THEN 'decreased'
                    ELSE 'no_change' END AS volume_change_label,
               CASE WHEN after_minus_before >= 10 OR after_before_pct_change >= 25 THEN 1 ELSE 0 END AS meaningful_increase_flag
        FROM vchange"""),
    "names": (["businesses"], """
        SELECT CAST(business_id AS VARCHAR) AS business_id, min(name) AS name FROM businesses GROUP BY 1"""),
    "cases": (["susbiz", "names"], """
        SELECT s.*, coalesce(n.name, '(unknown name)') AS name FROM susbiz s
        LEFT JOIN names n ON CAST(s.business_id AS VARCHAR) = n.business_id WHERE suspicious_user_count > 0"""),
    "cases_impact": (["cases", "impact"], """
        SELECT c.*, i.review_count AS review_count_impact, i.baseline_mean AS baseline_mean_impact,
               i.baseline_std AS baseline_std_impact, i.history_days AS history_days_impact,
               i.abs_increase AS abs_increase_impact, i.z_score AS z_score_impact,
               i.total_reviews_in_window AS total_reviews_in_window_impact,
               i.suspicious_reviews_in_window AS suspicious_reviews_in_window_impact,
               i.suspicious_user_count AS suspicious_user_count_impact,
               i.max_anomaly_score AS max_anomaly_score_impact, i.avg_anomaly_score AS avg_anomaly_score_impact,
               i.window_days AS window_days_impact, i.avg_stars_before, i.n_reviews_before, i.avg_stars_during,
               i.n_reviews_during, i.avg_stars_after, i.n_reviews_after, i.before_days, i.during_days, i.after_days,
               i.delta_after_before
        FROM cases c JOIN impact i ON c.business_id = i.business_id AND c.spike_date = i.spike_date"""),
    "flagged_rr": (["rr", "flagged"], """
        SELECT review_id, user_id, business_id, date FROM rr WHERE user_id IN (SELECT user_id FROM flagged)"""),
    "pairs": (["flagged_rr"], """
        SELECT a.review_id AS review_id_a, b.review_id AS review_id_b, a.user_id AS user_id_a, b.user_id AS user_id_b,
               a.business_id, CAST(floor(abs(epoch(a.date) - epoch(b.date)) / 86400) AS INTEGER) AS time_diff_days
        FROM flagged_rr a JOIN flagged_rr b ON a.business_id = b.business_id AND a.review_id < b.review_id
         AND abs(epoch(a.date) - epoch(b.date)) < 7 * 86400"""),
    "reviewers": (["flagged_rr"], "SELECT DISTINCT business_id, user_id FROM flagged_rr"),
}

EVENT_DOUBLES = ["baseline_mean", "baseline_std", "abs_increase", "z_score"]
SUSBIZ_DOUBLES = [*EVENT_DOUBLES, "max_anomaly_score", "avg_anomaly_score"]
STAR_DOUBLES = ["avg_stars_before", "avg_stars_during", "avg_stars_after"]
VOLUME_DOUBLES = ["baseline_mean", "abs_increase", "z_score", "suspicious_review_share", "after_before_pct_change"]
FEATURE_DOUBLES = ["avg_stars_given", "pct_5_star_reviews", "pct_1_star_reviews", "reviews_per_day"]


def oracle(uses: list[str], body: str, doubles: list[str] | None = None) -> str:
    """``body`` with the table expressions it uses in front, doubles rounded to six digits."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for dependency in TABLES[name][0]:
            visit(dependency)
        if name not in needed:
            needed.append(name)

    for name in uses:
        visit(name)
    if doubles:
        rounds = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({rounds}) FROM ({body})"
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in needed) + "\n" + body
