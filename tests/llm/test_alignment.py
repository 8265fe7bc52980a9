from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candor.llm import alignment

TEXTS = ["the cat sat, don't!", "", None, " ", "a  b \n c", "日本 é x1\n\ny", "a▁b", "<|endoftext|> <s> </s>", "the cat sat, don't!",
         "\x00\x1c x y ﬁ", "end ", " lead", "x" * 300, "🙂 👩‍👩‍👧 z"]


@pytest.fixture(scope="module")
def public():
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)


def tokens(public, text):
    """Ids and bytes of whole texts, from the public libraries; nothing where the bytes do not come back."""
    a, b = public
    if not text:
        return [], [], [], []
    shown = {x for x in range(256) if chr(x).isprintable() and x != 32}
    hidden = [x for x in range(256) if x not in shown]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    return (ids_a, raw_a, ids_b, raw_b) if b"".join(raw_a) == want == b"".join(raw_b) else ([], [], [], [])


def spans(raw):
    at, out = 0, []
    for x in raw:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def slow(public, texts):
    rows, count = [], Counter()
    for text in texts:
        ids_a, raw_a, ids_b, raw_b = tokens(public, text)
        a, b = spans(raw_a), spans(raw_b)
        links, near = [], 0
        for i, x in enumerate(a):
            while near < len(b) and b[near][1] <= x[0]:
                near += 1
            j = near
            while j < len(b) and b[j][0] < x[1]:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        count.update(links)
        cuts = sorted({y for _, y in a} & {y for _, y in b})
        parts, before = [], 0
        for cut in cuts:
            own = [[str(i) for i, (_, y) in zip(ids, s, strict=True) if before < y <= cut] for ids, s in ((ids_a, a), (ids_b, b))]
            parts.append(",".join(own[0]) + "|" + ",".join(own[1]))
            before = cut
        text = ";".join(parts)
        rows.append((len(a), len(b), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return [(n_a, n_b, n_g, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), digest)
            for n_a, n_b, n_g, links, digest, _ in rows], [r[5] for r in rows]


def test_statistics_groups_and_links_by_brute_force(spark, make, public, monkeypatch):
    pick = random.Random(5)
    texts = [*TEXTS, *["".join(pick.choice("ab é日\n'1. ") for _ in range(pick.randint(1, 60))) for _ in range(60)]]
    docs = make(texts).withColumn("block", F.lit("x")).withColumn("n_a", F.lit(None).cast("int"))
    want, written = slow(public, texts)
    got = alignment.link_statistics(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == want
    assert [r.groups for r in alignment.groups(docs).orderBy("doc_id").collect()] == written
    counted = {r.doc_id: r["count"] for r in alignment.overlaps(docs).groupBy("doc_id").count().collect()}
    assert [counted.get(i, 0) for i in range(len(texts))] == [r[3] for r in want]


def test_statistics_of_the_given_documents_in_many_blocks(spark, public, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 30_000)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(80).select("doc_id", "text").collect()
    want, _ = slow(public, [r.text for r in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = alignment.link_statistics(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == want


def test_repeated_null_and_missing_rows(spark):
    rows = [(None, "the cat"), (3, "the cat"), (3, "the cat"), (3, "a dog")]
    got = sorted(map(tuple, alignment.link_statistics(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert len(got) == 4 and [r[0] for r in got].count(None) == 1 and [r[0] for r in got].count(3) == 3
    none = spark.createDataFrame([], "doc_id long, text string, pairs int")
    assert alignment.link_statistics(none).collect() == []


def test_texts_cut_at_blanks_encode_as_whole_ones(public):
    with open(alignment.BYTE_VOCABULARY, "rb") as a, open(alignment.PIECE_MODEL, "rb") as b:
        vocabularies = alignment.ByteVocabulary(a.read()), alignment.PieceVocabulary(b.read())
    pick = random.Random(8)
    texts = ["".join(pick.choice("   \n\taéB日9'.-s🙂́") for _ in range(pick.randint(1, 40))) for _ in range(3000)]
    found = alignment.Aligned(texts, *vocabularies)
    for i, text in enumerate(texts):
        ids_a, _, ids_b, _ = tokens(public, text)
        assert found.a[0][found.a[1][i]:found.a[1][i + 1]].tolist() == ids_a
        assert found.b[0][found.b[1][i]:found.b[1][i + 1]].tolist() == ids_b
