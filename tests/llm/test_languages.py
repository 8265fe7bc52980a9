from __future__ import annotations

import zlib

from case_tables import SF, make  # noqa: F401

from candor.llm import compress_lang


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = compress_lang.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    assert sum(r.rejected for r in rows) / len(rows) < 0.01


def test_predictions_see_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = compress_lang.Classifier(compress_lang.learn(docs))
    rows = {r.doc_id: r for r in compress_lang.languages(docs).collect()}
    for r in docs.limit(20).collect():
        assert (rows[r.doc_id].lang_pred, rows[r.doc_id].score, rows[r.doc_id].rejected) == model.predict(r.text)
    relabelled = docs.withColumn("lang", compress_lang.F.when(compress_lang.fold(docs.doc_id) == 1, "xx").otherwise(docs.lang))
    assert compress_lang.learn(relabelled) == compress_lang.learn(docs)


def test_odd_texts_and_tables(spark, make):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = make([None, "", "123 !?", "ö", "the " * 100_000], lang=["en", None, "fr", None, None])
    shifted = odd.selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "source", "n_chars", "doc_id AS rejected")
    both = docs.withColumn("rejected", docs.doc_id).unionByName(shifted)
    rows = {r.doc_id: r for r in compress_lang.languages(both.union(shifted)).collect() if r.doc_id >= 100_000}
    assert [rows[100_000 + i].lang_pred for i in range(3)] == ["und"] * 3
    assert all(rows[100_000 + i].rejected and rows[100_000 + i].score == 0 for i in range(3))
    assert rows[100_003].lang_pred != "und" and rows[100_004].lang_pred == "en"
    kept = compress_lang.accepted(both)
    assert kept.columns == both.columns and kept.where("doc_id IN (100000, 100001, 100002)").isEmpty()
    assert compress_lang.languages(make([])).collect() == []
    assert [r.lang_pred for r in compress_lang.languages(make(["abc", "def"])).collect()] == ["und", "und"]


def _accuracy(docs):
    rows = compress_lang.languages(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("n_chars >= 200").collect()
    held = [r for r in rows if r.held_out and r.lang in ("de", "en", "es", "fr")]
    return sum(r.lang_pred == r.lang for r in held) / len(held), sum(r.rejected for r in rows) / len(rows)


def test_a_rare_label_or_many_copies_leave_the_others_whole(spark, make):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    base = compress_lang.learn(docs)
    text = docs.where("lang = 'en' AND n_chars > 400").first().text[:200]
    rare = make([text], lang=["enn"]).selectExpr("9000000L + doc_id AS doc_id", "text", "lang", "source", "n_chars")
    rare = rare.withColumn("doc_id", compress_lang.F.explode(compress_lang.F.sequence("doc_id", compress_lang.F.lit(9000008))))
    learned = compress_lang.learn(docs.unionByName(rare))
    assert {k: learned[k] for k in base} == base and 0 < len(learned["enn"]) <= 220
    right, rejected = _accuracy(docs.unionByName(rare))
    assert right >= 0.97 and rejected < 0.01
    copies = rare.withColumn("lang", compress_lang.F.lit("en")).withColumn(
        "doc_id", compress_lang.F.explode(compress_lang.F.sequence("doc_id", compress_lang.F.col("doc_id") + 3000)))
    assert len(compress_lang.learn(docs.unionByName(copies))["en"]) == len(base["en"])


def test_every_label_with_letters_has_a_dictionary(make):
    texts = [f"kurze worte {chr(97 + i % 26) * (1 + i // 26)}" for i in range(40)] + [f"long{'x' * i} " * 3000 for i in range(40)] + ["12 34"] * 9
    langs = ["short"] * 40 + ["long"] * 40 + ["none"] * 9
    learned = compress_lang.learn(make(texts, lang=langs))
    assert set(learned) == {"short", "long"} and all(len(raw) > 100 for raw in learned.values())
    many = [f"l{i}" for i in range(260) for _ in range(12)]
    learned = compress_lang.learn(make([f"text of {x} {chr(97 + n % 26) * 5} {n}" for n, x in enumerate(many)], lang=many))
    assert set(learned) == set(many)


def test_numbers_are_no_letters_and_marks_stay():
    assert [compress_lang._letters(t) for t in ("²", "½", "Ⅷ", "1234", "́", "_", "")] == [""] * 7
    assert compress_lang._letters("हिन्दी, Été 2") == " हिन्दी été "
