from __future__ import annotations

import pytest
from case_tables import make  # noqa: F401

from candor.llm import mixing


def test_margins_are_met_and_samples_follow(make):
    n = 3000
    texts = ["w " * (1 + i % 7) + ("copyright" if i % 5 == 0 else "") for i in range(n)]
    df = make(texts, lang=["en" if i % 3 else "fr" for i in range(n)],
              source=["big" if i % 10 < 7 else f"s{i % 3}" for i in range(n)])
    rows = mixing.mixture(df, tolerance=1e-8).collect()
    whole = sum(r.tokens for r in rows)
    assert len(rows) == n and abs(sum(r.tokens * r.weight for r in rows) / whole - 1) < 1e-6
    cells = {}
    for r in rows:
        key = r.source, r.lang, r.topic
        cells[key] = cells.get(key, 0) + r.tokens
    raised = sum(v ** mixing.TEMPERATURE for v in cells.values())
    for at, m in enumerate(mixing.MARGINS):
        have, got, kept = {}, {}, {}
        for r in rows:
            have[r[m]] = have.get(r[m], 0) + r.tokens
            got[r[m]] = got.get(r[m], 0) + r.tokens * r.weight
            kept[r[m]] = kept.get(r[m], 0) + r.tokens * r.kept
        for k in have:
            target = sum(v ** mixing.TEMPERATURE for c, v in cells.items() if c[at] == k) / raised
            assert abs(got[k] / whole - target) < 1e-5
            assert abs(kept[k] / sum(kept.values()) - target) < 0.05
    assert max(r.probability for r in rows) == 1.0
    kept = mixing.sampled(df, tolerance=1e-8)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_nulls_empty_texts_and_clashing_names(make):
    df = make([None, "", "a b", "a b c", "c"], lang=[None, "en", "en", None, "-"], source=["x", None, "x", "y", None])
    rows = {r.doc_id: r for r in mixing.mixture(df, tolerance=1e-8).collect()}
    assert [rows[i].tokens for i in range(5)] == [0, 0, 2, 3, 1]
    assert rows[0].kept and rows[1].kept and rows[0].weight == 1.0
    assert rows[0].lang == "-" and rows[4].lang == "=-" and rows[1].source == "-"
    clash = df.withColumnRenamed("n_chars", "tokens").withColumn("weight", df.doc_id).withColumn("row", df.doc_id)
    kept = mixing.sampled(clash, tolerance=1e-8)
    assert kept.columns == clash.columns and kept.count() >= 2
    assert mixing.mixture(make([])).collect() == [] and mixing.sampled(make([])).collect() == []


def test_targets_that_cannot_be_met_raise(spark):
    cells = spark.createDataFrame([("a", "x", "p", 5), ("b", "y", "p", 5)], "source string, lang string, topic string, tokens long")
    wanted = {"source": [("a", 0.9), ("b", 0.1)], "lang": [("x", 0.1), ("y", 0.9)], "topic": [("p", 1.0)]}
    frames = {m: spark.createDataFrame(v, f"{m} string, target double") for m, v in wanted.items()}
    with pytest.raises(RuntimeError):
        mixing.rake(cells, frames, max_cycles=2)


def test_first_topic_wins(make):
    texts = ["copyright | a | b | x", "a | b | c", "x@y.z 123 4567", "so!! good", "plain words"]
    rows = mixing.profile(make(texts)).collect()
    assert [r.topic for r in sorted(rows)] == ["=licence", "=table", "=contact", "=markup", "=prose"]


def raked_by_hand(cells, wanted, cycles=3000):
    """Plain proportional fitting over a dictionary of cells: shares of the whole."""
    mass = {c: v / sum(cells.values()) for c, v in cells.items()}
    for _ in range(cycles):
        for at, target in enumerate(wanted):
            sums = {}
            for c, v in mass.items():
                sums[c[at]] = sums.get(c[at], 0) + v
            mass = {c: v * target[c[at]] / sums[c[at]] if sums[c[at]] else 0.0 for c, v in mass.items()}
    return mass


def cells_of(rows):
    cells = {}
    for r in rows:
        key = r.source, r.lang, r.topic
        cells[key] = cells.get(key, 0) + r.tokens
    return cells


def mixed_table(make):
    n = 900
    return make(["w " * (1 + i % 7) + ("copyright" if i % 5 == 0 else "") for i in range(n)],
                lang=["en" if i % 3 else ("fr" if i % 2 else None) for i in range(n)],
                source=["big" if i % 10 < 7 else f"s{i % 2}" for i in range(n)])


def test_asked_shares_are_met_and_the_rest_is_divided(make):
    df = mixed_table(make)
    asked = {"source": {"s0": 0.3, "s1": 0.3, "big": 0.4}, "lang": {"fr": 0.5, None: 0.2}, "topic": {"licence": 0.2}}
    rows = mixing.mixture(df, tolerance=1e-5, asked=asked).collect()
    cells = cells_of(rows)
    whole = sum(cells.values())
    wanted = [{"=s0": 0.3, "=s1": 0.3, "=big": 0.4}, {"=fr": 0.5, "-": 0.2, "=en": 0.3}, {"=licence": 0.2, "=prose": 0.8}]
    mass = raked_by_hand(cells, wanted, 500)
    for r in rows:
        key = r.source, r.lang, r.topic
        assert r.weight == pytest.approx(mass[key] * whole / cells[key], rel=1e-3)
    kept = mixing.sampled(df, tolerance=1e-5, asked=asked)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    # Two levels of a margin are left out: they divide the rest as their tempered targets do.
    own = mixing.targets(cell_table(df), 0.9)["source"].collect()
    some = {r.source: r.target for r in mixing.asked_targets(cell_table(df), {"source": {"s0": 0.5}}, 0.9)["source"].collect()}
    plain = {r.source: r.target for r in own}
    assert some["=s0"] == pytest.approx(0.5) and sum(some.values()) == pytest.approx(1)
    assert some["=big"] / some["=s1"] == pytest.approx(plain["=big"] / plain["=s1"])


def cell_table(df):
    return mixing.profile(df).where("tokens > 0").groupBy(*mixing.MARGINS).agg({"tokens": "sum"}).withColumnRenamed(
        "sum(tokens)", "tokens")


def test_conflicting_shares_give_the_fit_reached_and_its_residuals(spark):
    cells = spark.createDataFrame([("=a", "=x", "=p", 5), ("=b", "=y", "=p", 5), ("=b", "=x", "=q", 10)],
                                  "source string, lang string, topic string, tokens long")
    asked = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.2, "y": 0.8}, "topic": {"p": 0.5, "q": 0.5}}
    wanted = mixing.asked_targets(cells, asked)
    raked = mixing.rake(cells, wanted, tolerance=1e-7, max_cycles=8, strict=False)
    got = {(r.margin, r.level): r for r in mixing.reached(cells, raked, wanted).collect()}
    assert len(got) == 6 and abs(got["topic", "=p"].residual) < 1e-9 and abs(got["topic", "=q"].residual) < 1e-9
    assert abs(got["source", "=a"].residual) > 0.1
    assert sum(r.share for r in got.values()) == pytest.approx(3)


def test_shares_that_make_no_sense_raise(spark):
    cells = spark.createDataFrame([("=a", "=x", "=p", 5)], "source string, lang string, topic string, tokens long")
    for asked in ({"colour": {"a": 1.0}}, {"source": {"a": 1.5}}, {"lang": {"x": -0.1}}, {"source": {"a": 0.0}}):
        with pytest.raises(ValueError):
            mixing.asked_targets(cells, asked)
    only = mixing.asked_targets(cells, {"source": {"gone": 0.7, "a": 0.3}})["source"].collect()
    assert [(r.source, r.target) for r in only] == [("=a", 1.0)]
