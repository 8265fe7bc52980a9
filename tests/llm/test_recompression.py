from __future__ import annotations

import random

import numpy as np
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F

from candor.llm import recompression
from candor.llm.queries import ORACLES, QUERIES  # noqa: F401


def slow(rows):
    """(doc_id, n_words, n_removed, kept) of (doc_id, text) rows, from a table of all windows."""
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, w in split:
        for x in range(len(w) - 12):
            if i is not None:
                key = tuple(w[x:x + 13])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for x in range(len(w) - 12):
            if i is not None and least[tuple(w[x:x + 13])] < i:
                gone.update(range(x, x + 13))
        out.append((i, len(w), len(gone), " ".join(v for x, v in enumerate(w) if x not in gone)))
    return sorted(out, key=str)


def texts_with_repeats(pick, n):
    passages = [[pick.choice("abcdefgh") * pick.randint(1, 2) for _ in range(pick.randint(5, 60))] for _ in range(12)]
    out = []
    for _ in range(n):
        w = []
        for _ in range(pick.randint(0, 6)):
            part = list(pick.choice(passages)) if pick.random() < 0.6 else [str(pick.randint(0, 40)) for _ in range(pick.randint(1, 30))]
            if pick.random() < 0.3 and part:
                part[pick.randrange(len(part))] = "changed"
            w += part[pick.randrange(3):] if pick.random() < 0.4 else part
            if pick.random() < 0.15:
                w += ["again"] * pick.randint(1, 40)
        out.append(pick.choice([" ", "\n", "  \t"]).join(w))
    return out


def test_removed_passages_by_brute_force_in_blocks_of_every_size(spark, make, monkeypatch):
    pick = random.Random(11)
    for block, bucket in ((300, 500), (2_000, 100), (4_000_000, 4_000_000)):
        monkeypatch.setattr(recompression, "BLOCK_BYTES", block)
        monkeypatch.setattr(recompression, "BUCKET_BYTES", bucket)
        texts = [None, "", " \n", "a", *texts_with_repeats(pick, 90), "z " * 12, "z " * 13, "z " * 30]
        rows = list(enumerate(texts))
        pick.shuffle(rows)
        docs = make([t for _, t in rows]).withColumn("block", F.lit(None).cast("string")).repartition(4)
        got = sorted(map(tuple, recompression.repeats_removed(docs).collect()), key=str)
        assert got == slow([(i, t) for i, (_, t) in enumerate(rows)])
        assert sum(r[2] for r in got) > 100


def test_the_given_documents_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(recompression, "BLOCK_BYTES", 200_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, recompression.repeats_removed(docs.repartition(6)).collect()), key=str)
    assert got == slow(rows)


def test_ids_that_are_null_shared_or_clashing(spark):
    long = " ".join(map(str, range(20)))
    rows = [(5, long), (5, long), (5, "x " + long), (None, long), (None, long), (7, long + " y"), (-3, "q " * 14), (9, "q " * 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, recompression.repeats_removed(docs).collect()), key=str) == slow(rows)
    assert recompression.repeats_removed(spark.createDataFrame([], "doc_id long, text string, n int")).collect() == []


def test_equal_windows_are_revealed_by_equal_symbols():
    pick = random.Random(2)
    texts = [t.split() for t in texts_with_repeats(pick, 200)]
    words = [w for t in texts for w in t]
    number = {w: np.uint64(pick.getrandbits(63)) for w in set(words)}
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    levels = recompression.parsed(np.array([number[w] for w in words], dtype=np.uint64), starts)
    at = np.array([x + i for x, t in zip(starts, texts) for i in range(len(t) - 12)])
    names = recompression.revealing(levels, at)
    seen = {}
    for x, name in zip(at.tolist(), names.tolist(), strict=True):
        assert seen.setdefault(tuple(words[x:x + 13]), name) == name
    assert len(set(names.tolist())) > 300
    spans = levels[-1].end - levels[-1].start
    assert spans.mean() > 2 and (levels[-1].start[1:] == levels[-1].end[:-1]).all()
