from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from candor.llm import maxscore


def slow(rows, k, step):
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (q, mine) in enumerate(v):
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(mine, other)), d) for m, (d, other) in enumerate(v) if m != n)[:k]
            out += [(q, r + 1, d, -s) for r, (s, d) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, step=3, **sizes):
    df = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<float>, score string")
    found = maxscore.top_k(maxscore.integer_vectors(df), F.col("vec_id") % step == 0, k, **sizes)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "skewed"])
def test_against_brute_force_in_many_shards(spark, kind):
    pick = random.Random(kind)
    rows = []
    for i in range(900):
        if kind == "dense":
            e = [pick.gauss(0, 0.12) for _ in range(24)]
        elif kind == "sparse":
            e = [pick.gauss(0, 1) if pick.random() < 0.08 else 0.0 for _ in range(40)]
        elif kind == "ties":
            e = [0.5, 0.25, 0.0] if i % 3 else [float(pick.randint(-1, 1)) for _ in range(3)]
        else:
            e = [pick.gauss(0, 1) * 4.0 ** -j for j in range(12)]
        rows.append((i, [float(F32(x)) for x in e]))
    assert run(spark, rows, shard_rows=400, block_rows=100) == slow(rows, 5, 3)


def F32(x):
    import struct
    return struct.unpack("f", struct.pack("f", x))[0]


def test_unusable_short_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, []), (6, [2.0, 0.25, 9.0]),
            (9, [0.0, 0.0]), (None, [1.0, 1.0]), (10, [-0.001, 1.0])]
    assert run(spark, rows) == slow(rows, 5, 3)
    again = rows + rows[:1] + [(6, [0.5]), (6, [2.0, 0.25, 9.0]), (0, [-1.0])]
    for first_rows in (4, 4096):
        assert run(spark, again, first_rows=first_rows) == slow(again, 5, 3)
    assert run(spark, []) == [] and run(spark, [(3, [1.0])]) == []
    with pytest.raises(ValueError):
        run(spark, [(0, [1e9]), (1, [1e9])])


def test_most_terms_are_not_essential_and_results_whole():
    import numpy as np
    pick = np.random.default_rng(1)
    rows = np.floor(64 * pick.normal(size=(4000, 32)) * 1.5 ** -np.arange(32))
    lists = maxscore.Postings(np.arange(4000), np.arange(4000), list(rows), 32)
    full = rows[:50] @ rows.T
    np.fill_diagonal(full, -np.inf)
    for limits in (np.full(50, -np.inf), np.sort(full[:, :1000], axis=1)[:, -20]):
        q, at, score = lists.search(rows[:50], np.arange(50), limits, 20)
        for i in range(50):
            want = np.lexsort((np.arange(4000), -full[i]))[:20]
            assert at[q == i].tolist() == want.tolist() and score[q == i].tolist() == full[i][want].tolist()
    upper = np.maximum(rows[:50] * lists.high, rows[:50] * lists.low) - np.minimum(rows[:50] * lists.high, rows[:50] * lists.low)
    ranked = -np.sort(-upper, axis=1)
    floor = np.minimum(rows[:50] * lists.high, rows[:50] * lists.low).sum(axis=1)
    essential = (floor[:, None] + np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1] >= limits[:, None]).sum(axis=1)
    assert essential.mean() < 16
