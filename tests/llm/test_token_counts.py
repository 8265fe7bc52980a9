from __future__ import annotations

import random

import pytest
from case_tables import SF, make  # noqa: F401
from pyspark.sql import functions as F

from candor.llm import token_counts

LETTERS = " '\n\tabresvdlmt12.,é日 "


@pytest.fixture(scope="module")
def counter():
    with open(token_counts.RANKS, "rb") as file:
        return token_counts.Counter(file.read())


def test_every_edit_leaves_the_tree_of_the_new_text(counter):
    pick = random.Random(3)
    for _ in range(400):
        text = "".join(pick.choice(LETTERS) for _ in range(pick.choice([0, 1, 5, 50, 600, 3000])))
        tree = token_counts.DocumentTree(text, counter)
        for _ in range(6):
            at, gone = pick.randint(0, len(text) + 2), pick.choice([0, 1, 2, 5, 80, 900])
            new = "".join(pick.choice(LETTERS) for _ in range(pick.choice([0, 1, 2, 5, 90, 2000])))
            tree.edit(at, gone, new)
            text = text[:at] + new + text[at + gone:]
            assert tree.text == text and tree.total == counter.whole(text) and tree.chars[1] == len(text)
            assert [n for c, _ in tree.leaves for n in c] == [len(p) for p in counter.cut.findall(text)]


def test_only_the_neighbourhood_is_encoded_again(counter):
    tree = token_counts.DocumentTree("plain words of text " * 50_000, counter)
    tree.edit(500_003, 7, "other")
    assert tree.reencoded < 100


def test_tables(spark, make):
    docs = make([None, "", "some text here", "don't"]).withColumnRenamed("source", "edited").withColumn("n_tokens", F.lit("x"))
    edits = spark.createDataFrame([(1, 1, 0, 0, "new words"), (2, 2, 0, 4, "any"), (2, 1, 10, 4, "there"), (3, 1, None, None, None),
                                   (9, 1, 0, 0, "x")], "doc_id long, seq int, start long, removed long, added string")
    rows = {r.doc_id: r for r in token_counts.edited_counts(token_counts.with_edits(docs, edits)).collect()}
    assert [rows[i].edited for i in range(4)] == ["", "new words", "any text there", "don't"]
    assert [rows[i].n_tokens for i in range(2)] == [0, 0] and rows[1].edited_tokens == 2
    assert rows[0].reencoded_chars == rows[3].reencoded_chars == 0
    assert token_counts.edited_counts(token_counts.with_edits(make([]), edits)).collect() == []


def test_given_documents_against_whole_encoding(spark, counter):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("edits", token_counts.standard_edits(docs.text, docs.doc_id))
    for r in token_counts.edited_counts(changed).collect():
        assert r.n_tokens == counter.whole(r.text) and r.edited_tokens == counter.whole(r.edited)
        assert r.edited != r.text
