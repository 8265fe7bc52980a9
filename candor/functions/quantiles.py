"""Exact quantiles by refined histograms: no sort, no window, no buffer of distinct values.

A sketch proposes a bracket round every wanted quantile. One scan then puts
each value of a column into one region: a gap between brackets, or one of the
equal steps of a bracket. The counts of all regions are exact, so they tell in
which one a place lies, whatever the sketch said; that region, shrunk to its own
smallest and largest value, is the bracket of the next round, where only values
inside it count. A region with one distinct value ends the search.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.scalars import finite

ACCURACY = 10_000
# Steps of a bracket. A round returns at most this many rows a bracket to the driver.
STEPS = 1024


@dataclass
class Bracket:
    """Values from ``lo`` to ``hi``; ``before`` of the column's values are smaller, where that is known."""

    lo: float
    hi: float
    before: int
    places: list[int]


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns; nulls, NaN and infinities are ignored.

    ``wanted`` maps a column to probabilities; all of them share one scan a
    round. ``None`` stands for a column without values. Rounds are few: zero is
    a border of its own, a bracket of one sign that spans more than a doubling is
    cut on a logarithmic scale, any other into 1024 equal parts.
    """
    sizes, brackets = _sketched(df, wanted)
    ends = {c: {math.floor(p * (n - 1)) for p in wanted[c]} | {math.ceil(p * (n - 1)) for p in wanted[c]}
            for c, n in sizes.items() if n}
    found: dict[str, dict[int, float]] = {c: {} for c in ends}
    brackets = {c: brackets[c] for c in ends}
    first = True
    while brackets:
        counts = _region_counts(df, brackets, gaps=first)
        brackets = {c: _refined(counts.get(c, {}), spans, sorted(ends[c]) if first else None, found[c])
                    for c, spans in brackets.items()}
        brackets = {c: spans for c, spans in brackets.items() if spans}
        first = False

    def value(c: str, p: float) -> float | None:
        if c not in ends:
            return None
        place = p * (sizes[c] - 1)
        low, high = found[c][math.floor(place)], found[c][math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))

    return {c: [value(c, p) for p in probs] for c, probs in wanted.items()}


def _sketched(df: DataFrame, wanted: dict[str, list[float]]) -> tuple[dict[str, int], dict[str, list[Bracket]]]:
    """Values per column, and disjoint brackets in ascending order round the wanted quantiles."""
    slack = 2.0 / ACCURACY
    sketch = []
    for c, probs in wanted.items():
        around = [min(1.0, max(0.0, p + s)) for p in probs for s in (-slack, slack)]
        sketch += [F.count(finite(c)).alias(f"n_{c}"),
                   F.percentile_approx(finite(c), around, ACCURACY).alias(f"b_{c}")]
    row = df.agg(*sketch).first()
    sizes, brackets = {}, {}
    for c in wanted:
        sizes[c] = row[f"n_{c}"]
        bounds = row[f"b_{c}"] or []
        spans: list[Bracket] = []
        for lo, hi in sorted(zip(bounds[::2], bounds[1::2])):
            if spans and lo <= spans[-1].hi:
                spans[-1].hi = max(hi, spans[-1].hi)
            else:
                spans.append(Bracket(lo, hi, 0, []))
        brackets[c] = spans
    return sizes, brackets


def _step(value: Column, lo: float, hi: float) -> Column:
    """Number of the value's step in its bracket, 0 to STEPS - 1; it never falls as the value grows.

    The ends of a bracket lie in different steps, so every round leaves fewer distinct values.
    """
    def equal(v: Column, a: float, b: float, steps: int) -> Column:
        share = (v - F.lit(a)) / F.lit(b - a)
        return F.greatest(F.lit(0), F.least(F.lit(steps - 1), F.floor(share * steps).cast("int")))

    if lo == hi:
        return F.lit(0)
    if lo < 0 < hi or lo == 0 or hi == 0:
        half = STEPS // 2 - 1
        under = equal(value, lo, 0.0, half) if lo < 0 else F.lit(0)
        over = F.lit(half + 1) + (equal(value, 0.0, hi, half) if hi > 0 else F.lit(0))
        return F.when(value < 0, under).when(value == 0, F.lit(half)).otherwise(over)
    if lo > 0 and hi / 2 > lo:
        return equal(F.log(value), math.log(lo), math.log(hi), STEPS)
    if hi < 0 and lo / 2 < hi:
        return equal(-F.log(-value), -math.log(-lo), -math.log(-hi), STEPS)
    return equal(value, lo, hi, STEPS)


def _region_counts(df: DataFrame, brackets: dict[str, list[Bracket]], gaps: bool) -> dict[str, dict[int, tuple]]:
    """Per column: region -> (values, smallest, largest), from one scan.

    Bracket i holds the regions from (2 i + 1) * STEPS on, the gap under it is
    region 2 i * STEPS. Each row gives at most one entry a column, none outside
    the brackets unless ``gaps`` are counted, and entries collapse map-side.
    """
    columns = list(brackets)
    entries = []
    for k, c in enumerate(columns):
        value = finite(c)
        region = None
        for i, b in enumerate(brackets[c]):
            gap = F.lit(2 * i * STEPS) if gaps else F.lit(None).cast("int")
            inside = F.lit((2 * i + 1) * STEPS) + _step(value, b.lo, b.hi)
            region = (F if region is None else region).when(value < b.lo, gap).when(value <= b.hi, inside)
        if gaps:
            region = region.when(value.isNotNull(), F.lit(2 * len(brackets[c]) * STEPS))
        entries.append(F.when(region.isNotNull(), F.struct(
            F.lit(k).alias("k"), region.alias("region"), value.alias("value"))))
    counted = (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        .groupBy("k", "region").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    out: dict[str, dict[int, tuple]] = {}
    for r in counted.collect():
        out.setdefault(columns[r["k"]], {})[r["region"]] = (r["n"], r["lo"], r["hi"])
    return out


def _refined(counts: dict[int, tuple], spans: list[Bracket], places: list[int] | None,
             found: dict[int, float]) -> list[Bracket]:
    """The next round's brackets of one column; values that are settled go to ``found``.

    With ``places`` the counts cover the whole column, so places are sought
    anywhere; otherwise each bracket's places are sought inside it.
    """
    left: list[Bracket] = []
    passed, last = 0, None
    for region in sorted(counts):
        n, lo, hi = counts[region]
        own = places
        if places is None:
            at = region // STEPS // 2
            if at != last:
                passed, last = spans[at].before, at
            own = spans[at].places
        inside = [p for p in own if passed <= p < passed + n]
        open_places = []
        for p in inside:
            if lo == hi or p == passed:
                found[p] = lo
            elif p == passed + n - 1:
                found[p] = hi
            else:
                open_places.append(p)
        if open_places:
            left.append(Bracket(lo, hi, passed, open_places))
        passed += n
    return left
