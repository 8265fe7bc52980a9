from __future__ import annotations

import hashlib
import re
import struct

import xxhash
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F

from candor.llm import syncmers


def chained(*values):
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
        seed -= (1 << 64) if seed >> 63 else 0
        seed &= (1 << 64) - 1
    return seed - (1 << 64) if seed >> 63 else seed


def slow_anchors(text):
    words = [chained(w) for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if len(words) < 5:
        return [(0, chained(*words) & 0x7FFFFFFF)] if words else []
    pairs = [chained(a, b) for a, b in zip(words, words[1:])]
    out = []
    for i in range(len(words) - 4):
        inner = pairs[i:i + 4]
        if min(inner) in (inner[0], inner[3]):
            out.append((i, chained(pairs[i], pairs[i + 2], pairs[i + 3]) & 0x7FFFFFFF))
    return out


def slow_match(a, b):
    """Likeness and offset of two lists of (place, hash)."""
    laid = sorted([(h, w, 0) for w, h in a] + [(h, w, 1) for w, h in b])
    met = [x[0] == y[0] and x[2] != y[2] for x, y in zip(laid, laid[1:])]
    hits = sum(x or y for x, y in zip([*met, False], [False, *met])) if laid else 0
    moved = [(y[1] - x[1]) * (1 if x[2] == 0 else -1) for x, y, m in zip(laid, laid[1:], met) if m]
    best = min(set(moved), key=lambda o: (-moved.count(o), abs(o), o), default=0)
    return (hits / 2) / (len(laid) - hits / 2) if laid else 1.0, best


def slow_rows(docs):
    order = sorted(docs, reverse=True)
    prints = {i: slow_anchors(docs[i]) for i in docs}
    out = {}
    for n, i in enumerate(order):
        text, after = docs[i] or "", order[(n + 1) % len(order)]
        half = len(text) // 2
        edited = text[:len(text) - half] + (docs[after] or "")[:half]
        own = slow_anchors(edited)
        near, offset = slow_match(prints[i], prints[after])
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), written(prints[i]), written(own),
                  round(slow_match(prints[i], own)[0], 9), round(near, 9), offset)
    return out


def written(found):
    return " ".join(f"{w << 31 | h:X}" for w, h in found)


def rows_of(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                       round(r.near_next, 9), r.next_offset) for r in syncmers.edit_matches(df).collect()}


def test_given_documents_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(df) == slow_rows({r.doc_id: r.text for r in df.collect()})
    assert dict(syncmers.edit_matches(df).dtypes) == {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
        "edited_fingerprint": "string", "near_edited": "double", "near_next": "double", "next_offset": "bigint"}


def test_odd_texts(make):
    texts = [None, "", " \n", "one", "a b c d", "a b c d e", "a\x0bb\fc\rd\te f", "é 日本 😀 ▁ x y", "w " * 5000,
             " ".join(f"w{i}" for i in range(20_000)), "same words in here now", "same words in here now", "x" * 50_000]
    df = make(texts).withColumnRenamed("source", "fingerprint")
    assert rows_of(df) == slow_rows(dict(enumerate(texts)))
    found = {(r.doc_id, r.word, r.hash) for r in syncmers.anchors(df).collect()}
    assert found == {(i, w, h) for i, t in enumerate(texts) for w, h in slow_anchors(t)}


def test_lone_repeated_and_nameless_rows(spark, make):
    assert syncmers.edit_matches(make([])).collect() == []
    assert rows_of(make(["a b c d e f"])) == slow_rows({0: "a b c d e f"})
    df = make(["a b c d e f g", "h i j k l m n"])
    assert rows_of(df.union(df)) == rows_of(df)
    assert syncmers.edit_matches(df.union(df)).count() == 4
    other = df.withColumn("text", F.concat("text", F.lit(" and more")))
    assert sorted(r.n_chars for r in syncmers.edit_matches(df.union(other).union(df)).collect()) == [13] * 4 + [22] * 2
    lone = df.withColumn("doc_id", F.lit(None).cast("long")).limit(1)
    extra = [r for r in syncmers.edit_matches(df.union(lone)).collect() if r.doc_id is None]
    assert [(r.n_chars, r.near_next) for r in extra] == [(13, 0.0)]


def test_a_passage_has_its_anchors_anywhere(make):
    passage = " ".join(f"p{i}" for i in range(300))
    df = make([passage, "before " * 40 + passage + " after" * 40])
    by = {}
    for r in syncmers.anchors(df).collect():
        by.setdefault(r.doc_id, {})[r.hash] = r.word
    assert len(by[0]) > 60
    assert {by[1][h] - w for h, w in by[0].items()} == {40}


def test_matches_see_passages_at_other_places(spark, make):
    passage = " ".join(f"p{i}" for i in range(100))
    a, b = (" ".join(f"{c}{i}" for i in range(3000)) for c in "ab")
    texts = [f"{b} {passage}", f"{passage} {a}", "w " * 5000, None, "one two"]
    rows = {r.doc_id: r for r in syncmers.edit_matches(make(texts)).collect()}
    # Document 1 is followed by 0: they share the passage, 3,000 words further on.
    assert rows[1].near_next > 0.01 and rows[1].next_offset == 3000
    assert rows[2].near_next == 0 and rows[4].near_next == 0
    assert 0.3 < rows[0].near_edited < 0.7 and rows[3].near_edited == 1.0
    same = {r.doc_id: r for r in syncmers.edit_matches(make([a, a])).collect()}
    assert same[0].near_next == 1.0 and same[0].next_offset == 0
    moved = {r.doc_id: r for r in syncmers.edit_matches(make(["a b c d e f g h i j", "x a b c d e f g h i j"])).collect()}
    assert moved[0].near_next == moved[1].near_next == 1.0
