from __future__ import annotations

import math
from collections import Counter

import pytest
import sentencepiece
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F

from candor.llm import pieces

TEXTS = ["", " ", "Hello world", "  two  blanks ", "line\n\nbreak\ttab", "▁ sign▁", "日本語 😀 ☃", "\x00\x7f", "a" * 3000,
         "née Straße niño", "word " * 20_000, " x\r\n"]


@pytest.fixture(scope="module")
def lattice():
    with open(pieces.MODEL, "rb") as file:
        return pieces.Lattice(file.read())


def encode(lattice, texts, keys):
    out = [[] for _ in texts]
    for rows, counts, ids in lattice.encode_many(texts, keys):
        at = 0
        for row, n in zip(rows, counts, strict=True):
            out[row] += ids[at:at + n].tolist()
            at += n
    return out


def test_lossless_also_by_the_public_decoder(lattice):
    public = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text, ids in zip(TEXTS, encode(lattice, TEXTS, range(len(TEXTS))), strict=True):
        assert lattice.decode(ids) == text
        if "▁" not in text:
            assert public.decode(ids) == text


def test_same_row_same_pieces_whatever_the_batch(lattice):
    together = encode(lattice, TEXTS, [f"k{i}" for i in range(len(TEXTS))])
    lattice._clear()
    for i in reversed(range(len(TEXTS))):
        assert encode(lattice, [TEXTS[i]], [f"k{i}"])[0] == together[i]


def test_samples_follow_the_lattice(lattice):
    """Against the chance of every segmentation of a word, enumerated."""
    word = "▁thandst"
    ways = {}

    def walk(at, found, chance):
        if at == len(word):
            ways[tuple(found)] = chance
        for stop in range(at + 1, len(word) + 1):
            piece = lattice.pieces.get(word[at:stop])
            if piece is not None:
                walk(stop, [*found, piece], chance * lattice.weight[piece])

    walk(0, [], 1.0)
    whole, n = sum(ways.values()), 40_000
    seen = Counter(map(tuple, encode(lattice, ["thandst"] * n, range(n))))
    assert set(seen) <= set(ways)
    for way, chance in ways.items():
        p = chance / whole
        assert abs(seen[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_tables_keep_rows_and_columns(spark, make):
    df = make([None, *TEXTS]).withColumnRenamed("source", "pieces")
    out = pieces.decode(pieces.encode(df))
    assert set(out.columns) == set(df.columns) | {"decoded"}
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].pieces is None and rows[0].decoded is None
    assert [rows[i + 1].decoded for i in range(len(TEXTS))] == TEXTS
    assert pieces.encode(make([])).collect() == []
    twice = pieces.encode(df.union(df)).groupBy("doc_id").agg(F.countDistinct("pieces").alias("n")).collect()
    assert all(r.n == (r.doc_id > 0) for r in twice)


def test_given_documents_come_back(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert pieces.decode(pieces.encode(docs)).where(~F.col("text").eqNullSafe(F.col("decoded"))).isEmpty()


def test_draws_stay_in_their_state_at_millions_of_states(monkeypatch):
    import numpy as np
    with open(pieces.MODEL, "rb") as file:
        lattice = pieces.Lattice(file.read())
    lattice.learn(["▁the", "▁cat"])
    moved = 1 << 21
    first = lattice.sample(np.array([lattice.known["▁the"]] * 2000), np.arange(2000, dtype=np.uint64))
    lattice.cum = lattice.cum + (moved << pieces._SHARE_BITS)
    lattice.prev = np.where(lattice.prev >= 0, lattice.prev + moved, -1)
    ends, seeds = np.array([lattice.known["▁the"] + moved] * 2000), np.arange(2000, dtype=np.uint64)
    counts, ids = lattice.sample(ends, seeds)
    assert counts.tolist() == first[0].tolist() and ids.tolist() == first[1].tolist() and len(set(counts.tolist())) > 1
    monkeypatch.setattr(pieces, "_mix", lambda x: np.full(len(x), (1 << 64) - 1, dtype=np.uint64))  # the largest draw there is
    counts, ids = lattice.sample(ends, seeds)
    assert all(lattice.decode(x) == "the" for x in np.split(ids, np.cumsum(counts)[:-1]))
