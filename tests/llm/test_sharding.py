from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from case_tables import SF, make  # noqa: F401

from candor.llm.sharding import GROUP_SHARE, SHARDS, balanced_shards


def check(df, shards=SHARDS):
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = balanced_shards(df, shards).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts if i is not None)
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total, largest = sum(r["size"] for r in rows), max((r["size"] for r in rows), default=0)
    for s in range(shards):
        # Each end of a shard is off by half a document or half a small group at most.
        assert abs(sum(r["size"] for r in by[s]) - total / shards) <= max(largest, total / shards * GROUP_SHARE) + 1
    return rows, total


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows, total = check(df)
    again = {(r.doc_id, r.shard, r.slot) for r in balanced_shards(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_hot_group_is_dealt_out_and_small_groups_stay(make):
    texts = ["copy " * 10] * 700 + [None] * 300 + [f"text {i % 400} " * 3 for i in range(1200)]
    rows, total = check(make(texts), 6)
    by = defaultdict(set)
    for r in rows:
        by[texts[r.doc_id]].add(r.shard)
    assert len(by["copy " * 10]) > 1
    assert all(len(s) == 1 for t, s in by.items() if t and t.startswith("text"))


@pytest.mark.parametrize("texts", [[], ["a"], [None, None, ""], ["x"] * 50, ["y" * 100_000, "b", "c"]])
def test_small_and_odd_tables(make, texts):
    if texts:
        check(make(texts).withColumnRenamed("source", "shard"), 3)
    else:
        assert balanced_shards(make([])).collect() == []
    assert balanced_shards(make([])).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_texts_larger_than_a_shard_stand_alone(make):
    for large in ([200_000], [200_000, 200_000, 30_000, 9_000]):
        texts = [f"{i} " * 80 for i in range(550)] + ["z" * n for n in large]
        rows, total = check(make(texts))
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r)
        assert len(by) == SHARDS
        alone = [n for n in sorted(large) if n > 20_000]
        assert [by[s][0]["size"] - 8 for s in range(SHARDS - len(alone), SHARDS)] == alone
        rest = [sum(r["size"] for r in by[s]) for s in range(SHARDS - len(alone))]
        assert max(rest) - min(rest) <= 2 * max(r["size"] for r in rows if r["size"] < 20_000)


def test_more_ranges_give_the_same_law(make, monkeypatch):
    monkeypatch.setattr("candor.llm.sharding.ROWS_PER_RANGE", 4)
    check(make([f"text {i % 300} " * (i % 7) for i in range(1000)]), 5)


def test_repeated_and_nameless_rows(spark, make):
    df = make(["a", "bb", "ccc"])
    more = df.union(df).union(spark.createDataFrame([(None, "a", None, None, 1)] * 2, df.schema))
    check(more, 2)
