"""Shards of near-equal bytes by sampled splitters over a key range."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candor.session import stored

SHARDS = 24
ROW_OVERHEAD = 8          # bytes of a row beside its text
RANGES_PER_SHARD = 32     # fine ranges at least, so that no task orders more than a small part of a shard
ROWS_PER_RANGE = 4_000_000  # more rows than that a range make more ranges
SAMPLES_PER_RANGE = 12    # expected draws between two neighbouring splitters
OVERFULL = 2.0            # a range is split again above this multiple of its share
GROUP_SHARE = 1 / 32      # of a shard: copies of one text up to this stay together, larger groups are dealt out
_MAX_DEPTH = 64


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, key``: equal texts share a key, a null text counts as empty in size and crc."""
    raw = F.coalesce(docs[text].cast("binary"), F.lit(bytearray()))
    return docs.select("doc_id", (F.octet_length(raw) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("key"))


def _sample(units: DataFrame, weight: Column, per_unit_weight: float, seed: int) -> list[tuple[int, int]]:
    """Sorted sample of (key, sub), each row drawn with a chance in proportion to its weight.

    The roll hangs on the row and the seed alone, so a task that runs again draws the same rows.
    """
    roll = F.pmod(F.xxhash64("doc_id", "key", "sub", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    rows = units.where(roll < weight * F.lit(per_unit_weight)).select("key", "sub").collect()
    return sorted((r.key, r.sub) for r in rows)


def _quantiles(sample: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """At most ``n - 1`` distinct boundaries at equal steps through a sorted sample."""
    picked = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []
    return sorted(set(picked))


def _range_of(splitters: list[tuple[int, int]]):
    """A column function: the number of splitters at or below (key, sub)."""
    firsts = np.array([k for k, _ in splitters], dtype=np.int64)
    alone = len(np.unique(firsts)) == len(firsts)

    @F.pandas_udf(T.IntegerType())
    def place(key: pd.Series, sub: pd.Series) -> pd.Series:
        at = np.searchsorted(firsts, key.to_numpy(), side="left")
        last = np.searchsorted(firsts, key.to_numpy(), side="right")
        out = at.astype(np.int32)
        # Only keys that are splitters themselves need the second half of the comparison.
        for i in np.flatnonzero(last > at):
            out[i] = at[i] + (splitters[at[i]][1] <= sub[i]) if alone else bisect.bisect_right(splitters, (key[i], sub[i]))
        return pd.Series(out)

    return place


def _giants(own: DataFrame, total_bytes: int, shards: int) -> tuple[int, float]:
    """How many rows are larger than a shard's share of what such rows leave, and that share.

    Of n shards fewer than n rows are, so the largest ``shards`` rows tell.
    """
    largest = [r["size"] for r in own.select("size").orderBy(F.desc("size")).limit(shards).collect()]
    n, rest = 0, total_bytes
    while n < len(largest) and largest[n] * (shards - n) > rest:
        n, rest = n + 1, rest - largest[n]
    return n, rest / (shards - n)


def balanced_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """Every row in one of ``shards`` contiguous key ranges of near-equal bytes.

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. The law is
    ``bytes``: shard sizes differ by about one document or one small group of
    copies. A row larger than a shard's share has a shard of its own, the last
    ones by size, and the others share what is left. The key is a hash of the text, so equal texts lie side by side and
    share a shard, unless the group alone is over ``GROUP_SHARE`` of a shard;
    such groups are ordered by a hash of doc_id and dealt out like single rows.
    Slots run from 0 without gaps in key order. Null texts count as empty;
    repeated rows each get a slot; an empty table gives an empty table; other
    columns are not read. ``grown_shard`` is null under this law.

    Splitters come from a size-weighted sample of about ``SAMPLES_PER_RANGE``
    keys a range. Ranges are ``shards * RANGES_PER_SHARD``, or one for
    ``ROWS_PER_RANGE`` rows if that is more. A range above ``OVERFULL`` times its
    share is sampled and split again. The driver holds splitters and one total a
    range.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    own = stored(sizes(docs), "sizes")
    total = own.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first().bytes
    n, share = _giants(own, total, shards)
    if not n:
        return _dealt_out(own, shards, seed)
    # Fewer rows than shards, so one task may number them.
    by_size = Window.orderBy("size", "key", "doc_id")
    giants = own.where(F.col("size") > share).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        (F.row_number().over(by_size) - 1 + F.lit(shards - n)).cast("int").alias("shard"),
        F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    return _dealt_out(stored(own.where(F.col("size") <= share), "sizes"), shards - n, seed).unionByName(giants)


def _dealt_out(own: DataFrame, shards: int, seed: int) -> DataFrame:
    """The shards of rows of which none is larger than a shard's share."""
    total = own.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    out = own.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"))
    if not total.rows:
        return out.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                          F.lit(None).cast("int").alias("grown_shard"))
    n_ranges = max(shards * RANGES_PER_SHARD, -(-total.rows // ROWS_PER_RANGE))
    # A range is bounded in bytes and in rows: a row weighs its bytes plus the mean row.
    weight = F.col("size") + F.lit(total.bytes / total.rows)
    weight_all = 2.0 * total.bytes
    large = (own.groupBy("key").agg(F.sum("size").alias("group_bytes"), F.sum(weight).alias("group_weight"))
             .where((F.col("group_bytes") > F.lit(total.bytes / shards * GROUP_SHARE))
                    | (F.col("group_weight") > F.lit(weight_all / n_ranges))).select("key"))
    # At most 2 * n_ranges groups are that large, so their keys are a bounded list.
    hot = sorted(r.key for r in large.collect())
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    units = own.withColumn("sub", F.when(is_hot, F.xxhash64("doc_id", F.lit(seed))).otherwise(F.lit(0).cast("long")))
    splitters = _quantiles(_sample(units, weight, n_ranges * SAMPLES_PER_RANGE / weight_all, seed), n_ranges)
    limit, depth = OVERFULL * weight_all / n_ranges, 0
    while True:
        dealt = units.withColumn("range", _range_of(splitters)("key", "sub"))
        totals = {r["range"]: r for r in dealt.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.sum(weight).alias("weight"),
            F.min(F.struct("key", "sub")).alias("low"), F.max(F.struct("key", "sub")).alias("high")).collect()}
        over = [k for k, r in totals.items() if r.weight > limit and r.low != r.high]
        if not over:
            break
        depth += 1
        if depth > _MAX_DEPTH:
            raise RuntimeError("ranges stay overfull after repeated splitting")
        inside = dealt.where(F.col("range").isin(over))
        drawn = _sample(inside, weight, n_ranges * SAMPLES_PER_RANGE / weight_all * 2 ** min(depth, 20), seed + depth)
        # The upper end of each overfull range is a splitter too, so every pass makes progress.
        splitters = sorted({*splitters, *_quantiles(drawn, max(2, len(drawn) // SAMPLES_PER_RANGE)),
                            *[tuple(totals[k].high) for k in over]})
    bytes_before, rows_before, b, r = [], [], 0, 0
    for k in range(len(splitters) + 1):
        bytes_before.append(b)
        rows_before.append(r)
        if k in totals:
            b, r = b + totals[k].bytes, r + totals[k].rows
    starts = F.from_json(F.lit(str(bytes_before)), "array<bigint>")
    row_starts = F.from_json(F.lit(str(rows_before)), "array<bigint>")
    in_range = Window.partitionBy("range").orderBy("key", "sub", "doc_id", "size")
    unit = Window.partitionBy("range", "key", "sub")
    upto = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (dealt.withColumn("before", upto - F.col("size"))
              .withColumn("place", F.row_number().over(in_range) - 1)
              .withColumn("unit_start", F.min("before").over(unit))
              .withColumn("unit_bytes", F.sum("size").over(unit)))
    middle = F.get(starts, F.col("range")) + F.col("unit_start") + F.col("unit_bytes") / 2
    placed = stored(placed.select(
        "doc_id", "size", "text_crc32",
        F.least(F.floor(middle * shards / F.lit(float(total.bytes))), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.get(row_starts, F.col("range")) + F.col("place")).alias("position")), "placed")
    first = {r.shard: r.low for r in placed.groupBy("shard").agg(F.min("position").alias("low")).collect()}
    firsts = F.from_json(F.lit(str([first.get(s, 0) for s in range(shards)])), "array<bigint>")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("position") - F.get(firsts, F.col("shard"))).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
