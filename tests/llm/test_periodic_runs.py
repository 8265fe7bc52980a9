from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F

from candor.llm import periodic_runs
from candor.llm.queries import QUERIES


def slow_runs(w):
    """Every period by itself, and every shorter period of what it finds."""
    n, out = len(w), []
    for p in range(1, n // 4 + 1):
        a = 0
        while a < n - p:
            e = a
            while e < n - p and w[e] == w[e + p]:
                e += 1
            length = e - a + p
            if e > a and length >= max(6, 4 * p) and not any(
                    all(w[i] == w[i + q] for i in range(a, a + length - q)) for q in range(1, p)):
                out.append((a, length, p))
            a = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_collapse(w, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return [x.decode() for x in (text or "").encode().split()]


def pick_text(pick):
    out = []
    while len(out) < pick.randint(0, 120):
        unit = [pick.choice("abc") for _ in range(pick.choice([1, 1, 2, 3, 5, 7, 12]))]
        out += unit * pick.randint(1, 7)
        if pick.random() < 0.3:
            out = out * 2
    return pick.choice([" ", "\n", " \t"]).join(out)


@pytest.mark.parametrize("tile", [periodic_runs.TILE_WORDS, 32, 64])
def test_runs_and_collapsed_texts_by_brute_force(spark, make, tile):
    pick = random.Random(tile)
    texts = [None, "", "  ", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "a " * 500, "a b " * 300 + "c " * 200,
             "\x1c a \x1c a \x1c a", " a " * 40, *[pick_text(pick) for _ in range(120)]]
    docs = make(texts).withColumn("runs", F.lit(1)).withColumn("key", F.lit("x")).repartition(3)
    for row in periodic_runs.collapsed(docs, tile=tile).collect():
        own = words(texts[row.doc_id])
        want = slow_runs(own)
        assert [tuple(r) for r in row.runs] == want, texts[row.doc_id]
        assert row.collapsed == slow_collapse(own, want)


def test_long_documents_are_tiled_and_stitched():
    pick = random.Random(3)
    for n in (50, 500, 3000):
        w = np.array([pick.randrange(3) for _ in range(n)])
        for _ in range(4):
            a, p = pick.randrange(n), pick.choice([1, 2, 9, 40, n // 5])
            w[a + p:] = [w[a + i % p] for i in range(n - a - p)] if a + p < n and pick.random() < 0.5 else w[a + p:]
        for tile in (32, 128, 1 << 16):
            spans = list(periodic_runs._tiles(n, tile))
            assert {k for low, high, _, _ in spans for k in range(low, high + 1)} >= set(range((n // 4).bit_length()))
            found: dict[int, list] = {}
            for low, high, x, y in spans:
                laid = np.concatenate(([-1], w[x:y], [-2]))
                for p, a, e in periodic_runs.boundary_runs(laid, low, high, y - x):
                    found.setdefault(p, []).append((x + a - 1, x + e - 1))
            got = []
            for p, parts in found.items():
                end = None
                for a, e in [*sorted(parts), (1 << 60, 0)]:
                    if end is None or a > end:
                        if end is not None and end - begin >= max(6 - p, 3 * p):  # noqa: F821
                            got.append((begin, end - begin + p, p))  # noqa: F821
                        begin, end = a, e
                    end = max(end, e)
            assert sorted(got, key=lambda r: (r[0], r[2])) == slow_runs(w.tolist()), (n, tile)


def test_the_query_against_brute_force_on_the_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert sorted(rows) == sorted(docs)
    planted = 0
    for doc_id, text in docs.items():
        w, h = words(text), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, row = slow_runs(w), rows[doc_id]
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
                hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(),
                hashlib.sha256(slow_collapse(w, runs).encode()).hexdigest())
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli, row.runs_sha256, row.collapsed_sha256) == want
    assert planted > 5


def test_repeated_rows_and_clashing_ids(spark):
    rows = [(1, "a a a a a a a"), (1, "a a a a a a a"), (1, "b b b b b b"), (None, "c c c c c c"), (None, None)]
    got = periodic_runs.collapsed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.collapsed, [tuple(x) for x in r.runs]) for r in got) == [
        ("1", "a", [(0, 7, 1)]), ("1", "a", [(0, 7, 1)]), ("1", "b", [(0, 6, 1)]), ("None", "", []), ("None", "c", [(0, 6, 1)])]
    assert periodic_runs.collapsed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    listed = periodic_runs.runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.start, r.length, r.period) for r in listed) == [("1", 0, 6, 1), ("1", 0, 7, 1), ("None", 0, 6, 1)]
