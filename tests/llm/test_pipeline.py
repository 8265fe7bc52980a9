from __future__ import annotations

import corpus_pipeline
from case_tables import SF, make  # noqa: F401

from candor.llm import compress_lang, mixing, pieces, simhash
from candor.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one_against_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = compress_lang.Classifier(compress_lang.learn(docs))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near copies", "mixture", "pieces"]
    want = sorted(docs.collect())
    steps = [f for _, f in corpus_pipeline.STAGES]
    first = steps[0](spark, docs, SF)
    want = [r for r in want if not model.predict(r.text)[2]]
    assert first.columns == COLUMNS and sorted(first.collect()) == want
    second = steps[1](spark, first, SF)
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(first).collect()}
    want = [r for r in want if classes[r.doc_id] == r.doc_id]
    assert second.columns == COLUMNS and sorted(second.collect()) == want
    third = steps[2](spark, second, SF)
    kept = {r.doc_id for r in mixing.mixture(second).collect() if r.kept}
    want = [r for r in want if r.doc_id in kept]
    assert third.columns == COLUMNS and sorted(third.collect()) == want
    last = steps[3](spark, third, SF).collect()
    assert sorted(r.doc_id for r in last) == [r.doc_id for r in want] and all(r.decoded == r.text for r in last)
    alone = {r.doc_id: r.pieces for r in pieces.encode(docs).collect()}
    assert all(alone[r.doc_id] == r.pieces for r in last)


def test_run_over_odd_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([
        (None, "the cat sat on the mat and looked at the dog " * 5, "en", "a", 1), (7_000_001, None, None, None, None),
        (7_000_002, "", "en", "a", 0), (7_000_003, " ", "en", None, 1)], docs.schema)
    first = docs.orderBy("doc_id").limit(1)
    other = docs.orderBy(docs.doc_id.desc()).limit(1).withColumn("doc_id", first.select("doc_id").first()[0] + docs.doc_id * 0)
    table = docs.union(odd).union(first).union(other)
    results = []
    for n in (1, 5):
        path = str(tmp_path / f"t{n}")
        table.repartition(n).write.parquet(f"{path}/documents.parquet")
        rows = corpus_pipeline.run(spark, path).collect()
        assert all(r.decoded == r.text for r in rows)
        results.append(sorted(((str(r.doc_id), r.text) for r in rows)))
    assert results[0] == results[1] and len(results[0]) > 10
    table.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
