"""Language identification by compression against one dictionary per language."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from statistics import median

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 3
HELD_OUT = 1               # this remainder of crc32(doc_id) is never learned from
UNDECIDED = "und"
# The bounded sample: distinct texts, whole or a passage of so many characters, until a dictionary is full.
PASSAGE_CHARS = 1000
DICTIONARY_BYTES = 112 * 1024
TOTAL_BYTES = 200 * DICTIONARY_BYTES  # of all dictionaries; more than 200 languages share it evenly
REFERENCES, PROBE_BYTES = 4, 6000     # languages and bytes of each by which the gain from size alone is measured
PIECE_CHARS = 1500         # a text is judged piece by piece, so that the dictionary counts over all of it
LEVEL = 6
MIN_MARGIN = 0.005         # below it the two smallest encodings are too close to tell
SHORT_CHARS, REPEATS = 300, 6  # shorter texts are repeated: zstandard keeps a few bytes raw, whatever the dictionary

_NOISE, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")
_ASCII_NOISE = re.compile(r"[^a-z]+")


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def _letters(text: str | None) -> str:
    """Lower-case letters and their marks with single blanks, also at both ends: case, digits and signs say nothing of a language here."""
    text = text.lower() if text else ""
    words = (_ASCII_NOISE if text.isascii() else _NOISE).sub(" ", text).strip()
    return f" {words} " if _LETTER.search(words) else ""


def learn(docs: DataFrame) -> dict[str, bytes]:
    """A dictionary of raw content per language, from the folds that are not held out.

    Of each language distinct texts are taken by the smallest hash of the text,
    short ones whole and a passage at a place drawn by hash of the others, until
    the dictionary has ``DICTIONARY_BYTES`` or the language has no more. So every
    language with a letter outside the held-out fold has a dictionary. Hashes
    above four times the share that is needed are passed over before the
    ranking; where that proves too few, the share is raised and the language
    read again. Documents without a language, a text or an id are not learned
    from.
    """
    spark = docs.sparkSession
    span = F.least(F.length("text"), F.lit(PASSAGE_CHARS))
    start = F.pmod(F.xxhash64("text", F.lit(6)), (F.length("text") - span + 1).cast("long")).cast("int")
    able = (docs.where(docs.lang.isNotNull() & docs.text.isNotNull() & docs.doc_id.isNotNull()
                       & (fold(docs.doc_id) != HELD_OUT)).select("lang", "text")
            .select("lang", F.xxhash64("text", F.lit(5)).alias("hash"), F.substring("text", start + 1, span).alias("part"))
            .withColumn("letters", F.length(F.regexp_replace("part", r"[^\p{L}]+", ""))).where("letters > 0"))
    have = able.groupBy("lang").agg(F.approx_count_distinct("hash").alias("texts"), F.avg("letters").alias("mean")).collect()
    if not have:
        return {}
    size = min(DICTIONARY_BYTES, TOTAL_BYTES // len(have))
    shares = {r.lang: min(1.0, 4 * (size / r.mean + 8) / r.texts) for r in have}
    order = Window.partitionBy("lang").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    roll = F.pmod("hash", F.lit(1 << 53)) / F.lit(float(1 << 53))
    joined: dict[str, bytes] = {}
    while shares:
        table = F.broadcast(spark.createDataFrame(list(shares.items()), "lang string, share double"))
        chosen = (able.withColumn("hash", F.xxhash64("hash")).join(table, "lang").where(roll < F.col("share"))
                  .dropDuplicates(["lang", "hash"])
                  .withColumn("before", F.coalesce(F.sum("letters").over(order), F.lit(0))).where(F.col("before") < size))
        parts: dict[str, list] = {}
        for r in chosen.select("lang", "hash", "part").collect():
            parts.setdefault(r.lang, []).append((r.hash, _letters(r.part)))
        for lang, rows in parts.items():
            joined[lang] = "".join(dict.fromkeys(t for _, t in sorted(rows))).encode()
        shares = {lang: min(1.0, 8 * x) for lang, x in shares.items() if x < 1 and len(joined.get(lang, b"")) < size}
    return {lang: raw[:size] for lang, raw in sorted(joined.items()) if raw}


def _coder(raw: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=content, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


def _gains(dictionaries: dict[str, bytes]) -> dict[str, float]:
    """What a dictionary of each one's size makes of texts in another language, as a share of the full size's result.

    Measured between the languages with the largest dictionaries, cut to
    growing sizes. Without two languages of at least half the largest size there
    is nothing to measure by, and all are one.
    """
    most = max(map(len, dictionaries.values()), default=0)
    if most == min(map(len, dictionaries.values()), default=0):
        return dict.fromkeys(dictionaries, 1.0)
    large = sorted((raw for raw in dictionaries.values() if 2 * len(raw) >= most), key=len, reverse=True)[:REFERENCES]
    if len(large) < 2:
        return dict.fromkeys(dictionaries, 1.0)
    probes = [raw[-PROBE_BYTES:] for raw in large]
    sizes = sorted({min(most, round(64 * 2 ** (i / 2))) for i in range(2 * math.ceil(math.log2(most / 64 + 1)) + 2)})
    plain = [_cost(_coder(b" "), p) for p in probes]
    curve = []
    for n in sizes:
        coders = [_coder(raw[:n]) for raw in large]
        curve.append(median(_cost(c, p) / x for i, c in enumerate(coders)
                            for k, (p, x) in enumerate(zip(probes, plain, strict=True)) if i != k))
    at = np.log([len(raw) for raw in dictionaries.values()])
    return dict(zip(dictionaries, (np.interp(at, np.log(sizes), curve) / curve[-1]).tolist(), strict=True))


def _cost(coder: zstandard.ZstdCompressor, raw: bytes) -> int:
    return sum(len(coder.compress(raw[i:i + PIECE_CHARS])) for i in range(0, len(raw), PIECE_CHARS))


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], gains: dict[str, float] | None = None):
        self.dictionaries, self._coders = dictionaries, None
        self.gains = _gains(dictionaries) if gains is None else gains

    def __reduce__(self):
        return Classifier, (self.dictionaries, self.gains)

    def _ready(self) -> list:
        if self._coders is None:
            self._coders = [(lang, self.gains[lang], _coder(raw)) for lang, raw in self.dictionaries.items()]
        return self._coders

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is wide enough.

        The score is the saving of the smallest encoding against the next,
        between 0 and 1, both set against what their dictionaries' sizes alone
        save; with a single language it is 1. Null and letterless
        texts are undecided with score 0 and rejected. Ties go to the first
        language in text order.
        """
        letters = _letters(text)
        coders = self._ready()
        if not letters or not coders:
            return UNDECIDED, 0.0, True
        if len(letters) < SHORT_CHARS:
            letters *= REPEATS
        pieces = [letters[i:i + PIECE_CHARS].encode() for i in range(0, len(letters), PIECE_CHARS)]
        costs = sorted((sum(len(c.compress(p)) for p in pieces) / gain, lang) for lang, gain, c in coders)
        if len(costs) == 1:
            return costs[0][1], 1.0, False
        best, second = costs[0][0], costs[1][0]
        margin = (second - best) / second
        return costs[0][1], margin, margin < MIN_MARGIN


_GUESS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("rejected", T.BooleanType())])


def guesses(dictionaries: dict[str, bytes], text: Column) -> Column:
    """``struct(lang_pred, score, rejected)`` of each whole text."""
    model = Classifier(dictionaries)

    @F.pandas_udf(_GUESS)
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score", "rejected"])

    return judge(text)


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per row.

    Learned as in ``learn``; predictions see the text alone. A null or
    letterless text is ``und``. Without any labelled text all are ``und``.
    Repeated rows are judged alike; an empty table gives an empty table.
    """
    model = learn(docs)
    return (docs.select("doc_id", F.coalesce(fold(docs.doc_id) == HELD_OUT, F.lit(False)).alias("held_out"),
                        guesses(model, docs.text).alias("guess"))
            .select("doc_id", "held_out", "guess.*"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is told by a clear margin, with their columns as they are."""
    model = learn(docs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), guesses(model, docs.text).alias("guess"))
    return rows.where(~F.col("guess.rejected")).select("row.*")
