from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candor.operators import authenticity, impact, reports, spikes

SPIKE = dt.date(2018, 9, 27)
REVIEWS = "review_id string, user_id string, business_id string, stars double, date timestamp_ntz"


def _rows(days, business="b", user="u"):
    """days: list of (date, [stars])"""
    out = []
    for day, stars in days:
        for n, s in enumerate(stars):
            out.append((f"{business}-{day}-{n}", f"{user}{day}{n}", business, s,
                        dt.datetime.combine(day, dt.time(12, n % 60))))
    return out


@pytest.fixture(scope="module")
def golden(spark):
    """The worked event: 30 active days before, three of the reviews inside the 30 calendar days."""
    early = [SPIKE - dt.timedelta(days=40 + i) for i in range(27)]
    late = [SPIKE - dt.timedelta(days=d) for d in (5, 12, 30)]
    days = [(early[0], [4.0, 4.0])] + [(d, [4.0]) for d in early[1:]] + [(d, [s]) for d, s in zip(late, (2.0, 3.0, 4.0))]
    days.append((SPIKE, [5.0] * 7))
    days += [(SPIKE + dt.timedelta(days=d), [s]) for d, s in zip((1, 2, 3, 10, 20, 30), (5.0, 5.0, 5.0, 5.0, 4.0, 4.0))]
    rows = _rows(days)
    reviews = spark.createDataFrame(rows, REVIEWS)
    on_day = [r[1] for r in rows if r[4].date() == SPIKE][:2]
    scores = spark.createDataFrame(
        [(on_day[0], 1, 0.0685724860983794), (on_day[1], 1, 0.06569324417192157), ("x", 0, 0.9)],
        "user_id string, is_anomaly int, anomaly_score double")
    return reviews, scores


def test_golden_event(golden):
    reviews, scores = golden
    found = spikes.review_spikes(reviews)
    events = spikes.spike_events(found)
    suspicious = impact.suspicious_businesses(events, reviews, scores)
    row = suspicious.collect()
    assert len(row) == 1
    row = row[0]
    assert row["spike_date"] == SPIKE
    assert row["baseline_mean"] == pytest.approx(31 / 30)
    assert row["baseline_std"] == pytest.approx(0.18257418583505536)
    assert row["history_days"] == 30
    assert row["abs_increase"] == pytest.approx(5.966666666666667)
    assert row["z_score"] == pytest.approx(32.680779264474914)
    assert (row["total_reviews_in_window"], row["suspicious_reviews_in_window"], row["suspicious_user_count"]) == (7, 2, 2)
    assert row["max_anomaly_score"] == pytest.approx(0.0685724860983794)
    assert row["avg_anomaly_score"] == pytest.approx(0.06713286513515049)

    daily = spikes.daily_totals(reviews)
    v = impact.volume_impact(suspicious, daily).first()
    assert (v["reviews_before_spike"], v["reviews_on_spike_date"], v["reviews_after_spike"]) == (3, 7, 6)
    assert (v["after_minus_before"], v["after_before_pct_change"]) == (3, 100.0)
    assert (v["total_reviews_in_impact_window"], v["suspicious_review_share"]) == (16, 0.125)
    assert (v["volume_change_label"], v["meaningful_increase_flag"]) == ("increased", 1)

    r = authenticity.rating_delta(impact.rating_impact(suspicious, daily)).first()
    assert (r["avg_stars_before"], r["n_reviews_before"]) == (3.0, 3)
    assert (r["avg_stars_during"], r["n_reviews_during"]) == (5.0, 7)
    assert r["avg_stars_after"] == pytest.approx(28 / 6) and r["n_reviews_after"] == 6
    assert r["delta_after_before"] == pytest.approx(1.6666666666666667)


def test_history_of_29_days_is_not_enough(golden, spark):
    reviews, _ = golden
    first = reviews.agg(F.min(F.to_date("date"))).first()[0]
    shorter = reviews.filter(F.to_date("date") > F.lit(first))
    assert spikes.spike_events(spikes.review_spikes(shorter)).count() == 0
    row = spikes.review_spikes(shorter).filter(F.col("review_date") == SPIKE).first()
    assert row["history_days"] == 29


def test_flat_baseline_has_no_z_score(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), [3.0]) for i in range(5)]
    out = spikes.review_spikes(spark.createDataFrame(_rows(days), REVIEWS)).orderBy("review_date").collect()
    assert [r["history_days"] for r in out] == [0, 1, 2, 3, 4]
    assert all(r["z_score"] is None for r in out)
    assert out[0]["baseline_mean"] is None and out[0]["abs_increase"] == 1.0
    assert out[1]["baseline_std"] is None


def _event(spark):
    return spark.createDataFrame([("b", SPIKE)], "business_id string, spike_date date")


def test_window_edges(spark):
    offsets = [-31, -30, -1, 0, 1, 30, 31]
    days = [(SPIKE + dt.timedelta(days=o), [3.0]) for o in offsets]
    daily = spikes.daily_totals(spark.createDataFrame(_rows(days), REVIEWS))
    v = impact.volume_counts(daily, _event(spark)).first()
    assert (v["reviews_before_spike"], v["reviews_on_spike_date"], v["reviews_after_spike"]) == (2, 1, 2)
    r = impact.rating_periods(daily, _event(spark), 30, 0, 30).first()
    assert (r["n_reviews_before"], r["n_reviews_during"], r["n_reviews_after"]) == (2, 1, 2)
    wide = impact.rating_periods(daily, _event(spark), 1, 31, 1).first()
    assert (wide["n_reviews_before"], wide["n_reviews_during"], wide["n_reviews_after"]) == (1, 7, 1)


def test_empty_periods_are_null_and_unrated_reviews_do_not_count(spark):
    rows = _rows([(SPIKE, [4.0]), (SPIKE + dt.timedelta(days=2), [None])])
    daily = spikes.daily_totals(spark.createDataFrame(rows, REVIEWS))
    r = impact.rating_periods(daily, _event(spark)).first()
    assert (r["avg_stars_after"], r["n_reviews_after"], r["n_reviews_before"]) == (None, None, None)
    v = impact.volume_counts(daily, _event(spark)).first()
    assert (v["reviews_before_spike"], v["reviews_after_spike"]) == (0, 1)


def test_event_without_reviews_in_reach_leaves_volume_but_not_rating(spark):
    rows = _rows([(SPIKE + dt.timedelta(days=90), [4.0])])
    daily = spikes.daily_totals(spark.createDataFrame(rows, REVIEWS))
    assert impact.volume_counts(daily, _event(spark)).count() == 0
    assert impact.rating_impact(_event(spark), daily).count() == 1


def test_one_pass_equals_three_joins(spark):
    from candor.plans.registry import Inputs
    from conftest import SF

    i = Inputs(spark, SF)
    reviews, events = i.narrow_reviews(), i.once("events", i.events)
    got = impact.rating_periods(spikes.daily_totals(reviews), events, 30, 3, 30)
    dated = reviews.select("business_id", F.to_date("date").alias("d"), "stars").filter("stars IS NOT NULL")
    parts = []
    for name, lo, hi in (("before", -30, -1), ("during", -3, 3), ("after", 1, 30)):
        e = events.select(F.col("business_id").alias("bid"), "spike_date")
        parts.append(
            dated.join(e, (F.col("business_id") == F.col("bid"))
                       & F.col("d").between(F.date_add("spike_date", lo), F.date_add("spike_date", hi)))
            .groupBy("business_id", "spike_date").agg(F.avg("stars").alias(f"avg_stars_{name}"),
                                                      F.count(F.lit(1)).alias(f"n_reviews_{name}")))
    want = parts[0]
    for p in parts[1:]:
        want = want.join(p, ["business_id", "spike_date"], "full_outer")
    want = want.select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_repeated_events_collapse(spark):
    events = spark.createDataFrame([("b", SPIKE, 2), ("b", SPIKE, 1), ("c", SPIKE, 3), (None, SPIKE, 4)],
                                   "business_id string, spike_date date, x int")
    got = {(r["business_id"], r["x"]) for r in impact.dedupe_events(events).collect()}
    assert got == {("b", 1), ("c", 3)}


def test_bad_parameters_raise(spark, golden):
    reviews, scores = golden
    with pytest.raises(ValueError):
        impact.spike_window_reviews(reviews, _event(spark), -1)
    with pytest.raises(ValueError):
        impact.rating_periods(spikes.daily_totals(reviews), _event(spark), 0, 0, 30)
    with pytest.raises(ValueError):
        impact.spike_timeline(spikes.daily_totals(reviews), _event(spark), 5)
    with pytest.raises(ValueError, match="business_id"):
        spikes.review_spikes(reviews.drop("business_id"))
    with pytest.raises(ValueError, match="is_anomaly"):
        impact.anomalous_users(scores.drop("is_anomaly"))
    with pytest.raises(ValueError):
        reports.top_suspicious_users(scores, 501)


PERIODS = {"before": (-30, -1), "around": (-4, 4), "on": (0, 0), "after": (1, 200)}


def test_period_totals_equal_a_plain_sum(spark):
    """Random days and events: overlapping periods, quiet businesses, repeated events, nulls, days without events."""
    import random

    draw = random.Random(5)
    start = dt.date(2020, 1, 1)
    days = {(b, start + dt.timedelta(days=draw.randrange(400))): (draw.randrange(1, 9), draw.randrange(0, 90) / 2)
            for b in ("hot", "mild", "no events") for _ in range(300 if b == "hot" else 40)}
    daily = spark.createDataFrame([(b, d, n, s) for (b, d), (n, s) in days.items()] + [(None, start, 5, 5.0)],
                                  "business_id string, review_date date, n long, s double")
    marks = [(b, start + dt.timedelta(days=draw.randrange(-20, 440))) for b in ("hot", "mild", "unknown") for _ in range(60)]
    marks = sorted(set(marks))
    events = spark.createDataFrame([*marks, marks[0], (None, start), ("hot", None)], "business_id string, spike_date date")
    got = {(r.business_id, r.spike_date): r for r in impact.period_totals(daily, events, PERIODS, ["n", "s"]).collect()}
    assert set(got) == set(marks)
    for b, at in marks:
        times = 2 if (b, at) == marks[0] else 1
        for name, (first, last) in PERIODS.items():
            inside = [v for (o, d), v in days.items() if o == b and first <= (d - at).days <= last]
            assert got[b, at][f"n_{name}"] == times * sum(n for n, _ in inside)
            assert got[b, at][f"s_{name}"] == times * sum(s for _, s in inside)


def test_period_totals_open_no_days(spark):
    daily = spark.createDataFrame([("b", SPIKE, 1, 1, 5.0)],
                                  "business_id string, review_date date, n_reviews long, n_stars long, sum_stars double")
    events = spark.createDataFrame([("b", SPIKE)], "business_id string, spike_date date")
    for df in (impact.rating_periods(daily, events), impact.volume_counts(daily, events)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(" not in plan and "Window" in plan
        assert df.count() == 1


def test_a_day_without_a_number_spoils_its_own_periods_only(spark):
    days = [(SPIKE + dt.timedelta(days=d), [s]) for d, s in ((-200, float("nan")), (-3, 4.0), (0, 2.0), (3, float("nan")))]
    daily = spikes.daily_totals(spark.createDataFrame(_rows(days), REVIEWS))
    events = spark.createDataFrame([("b", SPIKE), ("b", SPIKE + dt.timedelta(days=50))], "business_id string, spike_date date")
    row, *others = impact.rating_periods(daily, events, 60, 0, 60).orderBy("spike_date").collect()
    assert (row.avg_stars_before, row.avg_stars_during) == (4.0, 2.0) and row.avg_stars_after != row.avg_stars_after
    assert (row.n_reviews_after, len(others), others[0].n_reviews_before, others[0].avg_stars_after) == (1, 1, 3, None)
    assert others[0].avg_stars_before != others[0].avg_stars_before
