from __future__ import annotations

import random

import xxhash
from case_tables import SF, make  # noqa: F401

from candor.llm import simhash
from candor.llm.components import connected_components
from candor.session import stored


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, limit):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= limit:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def check(df, limit=simhash.MAX_DISTANCE):
    rows = df.select("doc_id", "text").collect()
    prints = {r.doc_id: slow_fingerprint(r.text) for r in rows}
    want = {i: (f"{prints[i]:016x}", c) for i, c in slow_components(prints, limit).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == want


def test_given_documents_against_brute_force(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_texts_ties_and_repeats(make):
    long = " ".join(f"w{i}" for i in range(30_000))
    check(make([None, "", " \t\n", "one", "ONE", "one two", "One\vTwo", "a b c d", "a  b\r\nc d", "é É ß", "x\u00a0y z",
                "same", "same", long, long + " end", "\u2003", "a b c d a b c d a b c d"]))


def test_links_up_to_four_bits_and_chains(spark):
    pick = random.Random(5)
    prints = []
    for _ in range(40):
        at = pick.getrandbits(64)
        for _ in range(6):
            prints.append(at)
            for b in pick.sample(range(64), pick.randint(1, 6)):
                at ^= 1 << b
    prints = {i: p for i, p in enumerate(dict.fromkeys(prints))}
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in prints.items()]
    table = spark.createDataFrame(signed, "fp long, rep long")
    pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.linked_pairs(table).collect()}
    assert pairs == {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4}
    for widths in ((22, 21, 21), (32, 32), (16, 16, 16, 16), (13, 13, 13, 13, 12)):
        assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in simhash.linked_pairs(table, widths=widths).collect()) == sorted(pairs)
    for limit in (0, 1, 2, 7):
        want = sorted((a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= limit)
        assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in simhash.linked_pairs(table, limit).collect()) == want
    found = {r.v: r.component for r in connected_components(stored(simhash.linked_pairs(table), "t"), "a", "b").collect()}
    assert found == {i: c for i, c in slow_components(prints, 4).items() if i in found}


def test_segments_widen_with_the_table():
    assert simhash.widths_for(0, 4) == simhash.widths_for(10 ** 7, 4) == (22, 21, 21)
    assert simhash.widths_for(10 ** 9, 4) == (32, 32)


def test_components(spark):
    shapes = [[(3, 1)], [(1, 1)], [(i, i + 1) for i in range(70)], [(0, i) for i in range(1, 50)], [(50, i) for i in range(50)],
              [(2, 3), (3, 2)], [(i, (i * 7 + 3) % 61) for i in range(61)], [(69 - i, 70 - i) for i in range(70)]]
    links = [(a + 1000 * n, b + 1000 * n) for n, s in enumerate(shapes) for a, b in s]
    want = {v: v for link in links for v in link}
    for _ in range(80):
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    df = spark.createDataFrame([*links, (None, 1), (2, None)], "x long, y long")
    assert {r.v: r.component for r in connected_components(df, "x", "y").collect()} == want
    assert connected_components(df.limit(0), "x", "y").collect() == []


def test_one_of_each_keeps_columns(spark, make):
    df = make(["a b c d e", "x y z u v", "a b c d e", None]).withColumnRenamed("source", "fingerprint")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3]
    twice = df.union(df).union(spark.createDataFrame([(None, "a b c d e", None, None, 1)], df.schema))
    assert sorted((r.doc_id for r in simhash.one_of_each(twice).collect()), key=str) == [0, 1, 3, None]


def test_rows_of_one_id_with_other_texts_all_stay(spark):
    far = " ".join(f"w{i}" for i in range(40))
    rows = [(5, "a b c d e f g", "x"), (5, far, "y"), (9, "q r s t u v", "z"), (9, far, "y"), (3, "k l m n o p", "x"), (3, "k l m n o p", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string")
    kept = {tuple(r) for r in simhash.one_of_each(docs).collect()}
    assert {r[:2] for r in kept} == {(5, "a b c d e f g"), (5, far), (9, "q r s t u v"), (3, "k l m n o p")} and len(kept) == 4
    for n in (1, 3, 7):
        assert {tuple(r) for r in simhash.one_of_each(docs.repartition(n)).collect()} == kept


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).collect() == []
    assert simhash.one_of_each(make([])).collect() == []
