"""SimHash fingerprints of whole texts, linked by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candor.llm.components import connected_components
from candor.session import stored

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_DISTANCE = 4
FP_BITS = 64
MOST_SEGMENTS = 3         # more are narrow, and real fingerprints crowd in narrow ones
_SLICE = 1 << 16


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as a signed number; no words: zero."""
    # On bytes, lower() and split() know ASCII only: exactly A-Z, and blank with \\x09-\\x0D.
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < words_each:
        hashes = np.array([digest(joined, HASH_SEED)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - words_each + 1]
        spans = zip(starts.tolist(), ends[words_each - 1:].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in spans), dtype="<u8", count=len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at:at + _SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([fingerprint(t) for t in part], dtype="int64")


def fingerprints(docs: DataFrame, text: str = "text") -> Column:
    return _fingerprints(docs[text])


def widths_for(n: int, max_distance: int) -> tuple[int, ...]:
    """Widths of the segments that cost least for ``n`` fingerprints: probes, and the entries that each finds by chance."""
    def cost(widths):
        balls = [(w, sum(comb(w, d) for d in range(r + 1)) / 2) for _, w, r in _segments(widths, max_distance) if r >= 0]
        return sum(probes * (1 + n / 2 ** w) for w, probes in balls)

    splits = [tuple(FP_BITS // k + (i < FP_BITS % k) for i in range(k)) for k in range(2, max(MOST_SEGMENTS, max_distance // 2) + 1)]
    return min(splits, key=cost)


def _segments(widths: tuple[int, ...], max_distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius): if no segment lies within its radius, the whole distance is over the limit."""
    base, rest = divmod(max_distance, len(widths))
    shifts = np.cumsum((0, *widths[:-1])).tolist()
    return [(s, w, base if i <= rest else base - 1) for i, (s, w) in enumerate(zip(shifts, widths, strict=True))]


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _balls(fp: Column, at: int, shift: int, width: int, radius: int) -> Column:
    """Table keys within ``radius`` of the segment and not below it: of two segments the lesser one meets the other."""
    own = _part(fp, shift, width)
    masks = [sum(1 << b for b in bits) for d in range(radius + 1) for bits in combinations(range(width), d)]
    ball = F.transform(F.from_json(F.lit(str(masks)), "array<bigint>"), lambda m: own.bitwiseXOR(m))
    return F.transform(F.filter(ball, lambda k: k >= own), lambda k: k.bitwiseOR(F.lit(at << 32)))


def linked_pairs(prints: DataFrame, max_distance: int = MAX_DISTANCE, widths: tuple[int, ...] | None = None) -> DataFrame:
    """``(a, b)`` representatives of all fingerprints at most ``max_distance`` bits apart.

    ``prints(fp, rep)`` holds each fingerprint once. Every fingerprint enters one
    table per segment; probes enumerate the Hamming ball of each segment. A pair
    is kept by the first segment that brings it together, after its whole
    distance is verified, so it comes once. ``widths`` of the segments, 32 bits
    at most each, follow the number of fingerprints; every choice gives the same
    pairs.
    """
    if max_distance < 0:
        raise ValueError("max_distance must not be negative")
    widths = widths or widths_for(prints.count(), max_distance)
    if sum(widths) != FP_BITS or max(widths) > 32:
        raise ValueError("segments of 1 to 32 bits must make up the fingerprint")
    parts = _segments(widths, max_distance)
    fp = F.col("fp")
    table = prints.select(F.explode(F.array(
        *[_part(fp, s, w).bitwiseOR(F.lit(i << 32)) for i, (s, w, r) in enumerate(parts) if r >= 0])).alias("key"),
        fp.alias("y"), F.col("rep").alias("rep_y"))
    probes = prints.select(F.explode(F.concat(
        *[_balls(fp, i, s, w, r) for i, (s, w, r) in enumerate(parts) if r >= 0])).alias("key"),
        fp.alias("x"), F.col("rep").alias("rep_x"))
    diff = F.col("x").bitwiseXOR(F.col("y"))
    segment = F.shiftrightunsigned("key", 32)
    apart = [F.bit_count(_part(diff, s, w)) for s, w, _ in parts]
    first = F.lit(False)
    for i, (_, _, r) in enumerate(parts):
        once = (segment == i) & ((apart[i] > 0) | (F.col("x") < F.col("y")))
        for j in range(i):
            once = once & (apart[j] > parts[j][2])
        first = first | once
    return (probes.join(table, "key").where((F.bit_count(diff) <= max_distance) & first)
            .select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b")))


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Copies share a fingerprint and are searched once, through their smallest
    doc_id; links run between different fingerprints only. A null or empty text
    has fingerprint zero and is linked like any other; a null doc_id is no
    candidate for a component id; other columns are not read.
    """
    own = stored(docs.select("doc_id", fingerprints(docs).alias("fp")), "fingerprints")
    prints = stored(own.groupBy("fp").agg(F.min("doc_id").alias("rep")), "prints")
    pairs = linked_pairs(prints.where("rep IS NOT NULL"), max_distance)
    found = connected_components(pairs, "a", "b")
    classes = stored(prints.join(found, prints.rep == found.v, "left")
                     .select("fp", F.coalesce("component", "rep").alias("component_id")), "classes")
    return own.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The documents without near copies: one row of each component stays, columns as they are.

    It is a row with the component's smallest doc_id; of several the one with the
    smallest fingerprint, then text hash, then hash of the whole row, so a rerun
    keeps the same. Rows of one doc_id whose texts are not linked belong to
    components of their own, and each of these keeps a row. A row without a
    doc_id has no identity to be linked by and stays.

    Rows are chosen by numbers alone, three a row; texts meet the choice in a
    semi-join, and are grouped only where some row is repeated.
    """
    named = docs.where("doc_id IS NOT NULL")
    text_hash = F.xxhash64("text")
    own = stored(named.select(F.col("doc_id").alias("id"), text_hash.alias("h"), fingerprints(named).alias("fp")), "fingerprints")
    prints = stored(own.groupBy("fp").agg(F.min("id").alias("first")), "prints")
    found = connected_components(linked_pairs(prints.select("fp", F.col("fp").alias("rep")), max_distance), "a", "b")
    classes = prints.join(found, prints.fp == found.v, "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    best = classes.groupBy("class").agg(F.min(F.struct("first", "fp")).alias("x")).select(
        F.col("x.first").alias("id"), F.col("x.fp").alias("fp"))
    texts = own.groupBy("id", "fp", "h").agg(F.count("*").alias("n")).join(best, ["id", "fp"], "left_semi")
    chosen = stored(texts.groupBy("id", "fp").agg(F.min(F.struct("h", "n")).alias("x")).select(
        F.col("id").alias("_id"), F.col("x.h").alias("_h"), F.col("x.n").alias("_n")), "chosen")
    kept = named.join(chosen.drop("_n"), (named.doc_id == F.col("_id")) & (F.xxhash64(named.text) == F.col("_h")), "left_semi")
    if not chosen.where("_n > 1").isEmpty():
        alike = kept.select(F.struct(*kept.columns).alias("row")).groupBy(F.col("row.doc_id"), F.xxhash64("row.text"))
        kept = alike.agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))
