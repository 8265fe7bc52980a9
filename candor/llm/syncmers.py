"""Document fingerprints from closed syncmers over words, in DataFrame functions alone."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.session import stored

K = 5            # words of a k-mer
S = 2            # words of an inner substring; K - S + 1 of them lie in a k-mer
KEY = "struct<doc_id:bigint,h:bigint>"
_BLANK = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\f\r"
_MASK = 0x7FFFFFFF


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK))


def _with_hashes(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_h``, a hash a word, and ``_g``, a hash for every two neighbouring words (the last is null)."""
    rows = rows.withColumn("_h", F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)))
    after = F.slice("_h", F.lit(2), F.greatest(F.size("_h"), F.lit(1)))
    return rows.withColumn("_g", F.zip_with("_h", after, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))))


def _chosen(i: Column, x: Column) -> Column:
    """Whether the k-mer at place ``i`` has its smallest inner substring first or last; ``x`` is the first."""
    inner = [F.get("_g", i + j) for j in range(1, K - S)]
    return F.least(x, F.get("_g", i + K - S)) <= F.least(*inner)


def _kmer(i: Column, x: Column) -> Column:
    """A 31-bit hash of all words of the k-mer at ``i``: word pairs that together cover it."""
    pairs = [F.get("_g", i + j) for j in (*range(S, K - S, S), K - S)]
    return F.xxhash64(x, *pairs).bitwiseAND(F.lit(_MASK)).cast("int")


def _whole(rows_h: str = "_h") -> Column:
    """Texts shorter than a k-mer are one k-mer of all their words; no words, none."""
    one = F.array(F.xxhash64(F.col(rows_h)).bitwiseAND(F.lit(_MASK)).cast("int"))
    return F.when(F.size(rows_h) > 0, one).otherwise(F.array().cast("array<int>"))


def _starts() -> Column:
    return F.slice("_g", F.lit(1), F.greatest(F.size("_h") - F.lit(K - 1), F.lit(0)))


def anchors(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, word, hash``: every closed syncmer of every whole text with the place of its first word, from 0.

    Whether a k-mer is chosen depends on its own words alone, so a passage has
    the same anchors wherever it stands, and equal hashes align texts by their
    places. Texts shorter than a k-mer have one anchor of all their words; null
    and blank texts have none; repeated rows have theirs each.
    """
    rows = _with_hashes(docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t")
    found = F.array_compact(F.transform(_starts(), lambda x, i: F.when(
        _chosen(i, x), F.struct(i.alias("word"), _kmer(i, x).alias("hash")))))
    short = F.transform(_whole(), lambda x: F.struct(F.lit(0).alias("word"), x.alias("hash")))
    return rows.select("doc_id", F.inline(F.when(F.size("_h") < K, short).otherwise(found)))


def as_text(fingerprint: Column) -> Column:
    """Anchors by place, each ``word << 31 | hash`` in hex digits, parted by blanks."""
    return F.array_join(F.transform(fingerprint, lambda x: F.hex(x)), " ")


def _with_next(keys: DataFrame) -> DataFrame:
    """``key, next_key``: every key with the following one from the largest down; the last is followed by the first.

    Keys are range-partitioned and stored, so that each slice is numbered within
    itself. What a slice's last key needs is the first key of the next slice: one
    row a slice, which the driver chains.
    """
    ordered = stored(keys.repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()), "ordered")
    heads = {r.part: r.top for r in ordered.groupBy("part").agg(F.max("key").alias("top")).collect()}
    parts = sorted(heads)
    after: list = [None] * (max(parts, default=-1) + 1)
    for at, part in enumerate(parts):
        after[part] = heads[parts[(at + 1) % len(parts)]].asDict()
    first = F.get(F.from_json(F.lit(json.dumps(after)), f"array<{KEY}>"), F.col("part"))
    following = F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("key")))
    return ordered.select("key", F.coalesce(following, first).alias("next_key"))


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: every anchor of the whole text as ``word << 31 | hash``, by place."""
    found = F.array_compact(F.transform(_starts(), lambda x, i: F.when(
        _chosen(i, x), F.shiftleft(i.cast("long"), 31).bitwiseOR(_kmer(i, x).cast("long")))))
    short = F.transform(_whole(), lambda x: x.cast("long"))
    return _with_hashes(rows, text).withColumn(out, F.when(F.size("_h") < K, short).otherwise(found)).drop("_h", "_g")


def with_matches(rows: DataFrame, a: str, b: str, near: str, offset: str | None = None) -> DataFrame:
    """Adds ``near``, and ``offset``: by how many words most matched anchors of ``b`` stand behind those of ``a``.

    Anchors of both texts are laid out by hash, then place; neighbours of one
    hash from different texts match. ``near`` is the mean m of the matched
    anchors of both over all anchors less m: 1 for equal texts, also without any
    word, wherever in the texts a shared passage stands. Of offsets with equal
    support the nearest to zero counts, then the smaller.
    """
    def keys(side):
        return lambda x: F.shiftleft(x.bitwiseAND(F.lit(_MASK)), 32).bitwiseOR(
            F.shiftleft(F.shiftright(x, 31), 1)).bitwiseOR(F.lit(side))

    def joins(x, y):
        return (F.shiftright(x, 32) == F.shiftright(y, 32)) & (x.bitwiseXOR(y).bitwiseAND(F.lit(1)) == 1)

    def place(x):
        return F.shiftright(x.bitwiseAND(F.lit(0xFFFFFFFF)), 1)

    def behind(x, y):
        return F.when(x.bitwiseAND(F.lit(1)) == 0, place(y) - place(x)).otherwise(place(x) - place(y))

    rows = rows.withColumn("_k", F.array_sort(F.concat(F.transform(a, keys(0)), F.transform(b, keys(1)))))
    rows = rows.withColumn("_n", F.slice("_k", F.lit(2), F.greatest(F.size("_k"), F.lit(1))))
    if offset:
        rows = rows.withColumn("_o", F.array_sort(F.array_compact(F.zip_with(
            "_k", "_n", lambda x, y: F.when(joins(x, y), behind(x, y))))))
        zero = F.struct(*[F.lit(0).cast("long").alias(n) for n in ("at", "n", "best", "most")])

        def count(s, o):
            n = F.when(s["at"] == o, s["n"] + 1).otherwise(F.lit(1).cast("long"))
            more = (n > s["most"]) | ((n == s["most"]) & (F.abs(o) < F.abs(s["best"])))
            return F.struct(o.alias("at"), n.alias("n"), F.when(more, o).otherwise(s["best"]).alias("best"),
                            F.when(more, n).otherwise(s["most"]).alias("most"))

        rows = rows.withColumn(offset, F.aggregate("_o", zero, count, lambda s: s["best"])).drop("_o")
    rows = rows.withColumn("_j", F.zip_with("_k", "_n", lambda x, y: F.coalesce(joins(x, y), F.lit(False))))
    last = F.concat(F.array(F.lit(False)), F.col("_j"))
    hits = F.size(F.filter(F.zip_with("_j", last, lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))), lambda x: x))
    rows = rows.withColumn("_m", hits / 2.0)
    whole = F.size("_k") - F.col("_m")
    return rows.withColumn(near, F.when(F.size("_k") == 0, 1.0).otherwise(F.col("_m") / whole)).drop("_k", "_n", "_j", "_m")


def edit_matches(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are, from all anchors with their places.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, next_offset``. The edited text has its last
    floor(n_chars / 2) code points replaced by the first as many (or all) of the
    next document by descending doc_id; the last is followed by the first, a lone
    one by itself. Rows that share a doc_id follow each other by a hash of their
    texts; rows equal in both stand in the order once, and each of them gives a
    row. Null texts count as empty. A row without a doc_id has no next document:
    its edited text is what remains, and ``near_next`` is 0. A fingerprint lists
    all anchors, see ``as_text``; ``near_edited`` and ``near_next`` are the same
    likeness, see ``with_matches``; ``next_offset`` tells by how many words the
    passages shared with the next document are moved. Other columns are not read.

    Anchors are made where the texts meet and not stored; keys alone are ordered,
    and a text moves once as itself and once as the next.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = texts.where("doc_id IS NOT NULL").select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("key"), "text")
    keys = stored(named.select("key"), "keys")
    own, lenders = keys.distinct(), named
    if own.count() < keys.count():
        lenders = named.groupBy("key").agg(F.max("text").alias("text"))
    asks = stored(_with_next(own).withColumnRenamed("key", "asker"), "asks")
    lent = lenders.join(asks, F.col("key") == F.col("next_key")).select("asker", F.col("text").alias("next_text"))
    pairs = named.join(lent, F.col("key") == F.col("asker")).select(F.col("key.doc_id").alias("doc_id"), "text", "next_text")
    pairs = pairs.unionByName(texts.where("doc_id IS NULL").withColumn("next_text", F.lit("")))
    pairs = pairs.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(
        F.left("text", F.expr("CAST(n_chars - n_chars DIV 2 AS int)")), F.left("next_text", F.expr("CAST(n_chars DIV 2 AS int)"))))
    rows = with_anchors(pairs, "text", "fingerprint")
    rows = with_anchors(rows, "next_text", "_next").drop("text", "next_text")
    rows = with_matches(rows, "fingerprint", "_next", "near_next", "next_offset").drop("_next")
    rows = with_matches(with_anchors(rows, "edited", "edited_fingerprint"), "fingerprint", "edited_fingerprint", "near_edited")
    lone = F.col("doc_id").isNull()
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited",
        F.when(lone, 0.0).otherwise(F.col("near_next")).alias("near_next"),
        F.when(lone, 0).otherwise(F.col("next_offset")).alias("next_offset"))
