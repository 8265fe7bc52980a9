"""Maximal periodic runs of words, found in tiles by period octave and stitched by document and period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candor.llm.blocks import by_bytes, words

LEAST_WORDS = 6
LEAST_PERIODS = 4
TILE_WORDS = 65_536     # words of a tile of the small octaves; a document of up to so many is one tile for all octaves
_LAP = 8                # words, in lower ends of the octave, that neighbouring tiles share
_TILE = 32              # words, in lower ends of the octave, of a tile of one large octave
_ALL_OCTAVES = 62
_PREFIX = 64            # words that have to agree at a boundary before a period is looked at by itself
_BATCH_BYTES, _SOLVED_WORDS = 4_000_000, 1_000_000

_TILES = pa.schema([("key", pa.string()), ("low", pa.int32()), ("high", pa.int32()), ("first", pa.int64()),
                    ("total", pa.int64()), ("codes", pa.binary())])
_TILES_SPARK = "key string, low int, high int, first long, total long, codes binary"


def _tiles(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, from, to) of every tile of a document of ``n`` words.

    Periods of octave k are 2^k to 2^(k+1) - 1. A run repeats its period four
    times, so two words a period apart agree over three periods. Tiles of an
    octave share 8 * 2^k words, more than its longest period and those words in
    which a run is found: what one tile cuts off, the next one holds.
    """
    if n <= tile:
        yield 0, _ALL_OCTAVES, 0, n
        return
    last = max((tile // _TILE).bit_length() - 1, 0)
    sizes = [(0, last, tile)]
    while LEAST_PERIODS << (last + 1) <= n:
        last += 1
        sizes.append((last, last, _TILE << last))
    for low, high, size in sizes:
        step = size - (_LAP << high)
        for t in range(max(0, -(-(n - size) // step)) + 1):
            yield low, high, t * step, min(t * step + size, n)


def _agree(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` on, going by ``step`` (1 or -1), equal those from ``b`` on; ends differ by themselves."""
    done, size = 0, 64
    while True:
        if step > 0:
            u, v = x[a + done:a + done + size], x[b + done:b + done + size]
        else:
            u, v = (x[max(at - done - size + 1, 0):at - done + 1][::-1] for at in (a, b))
        most = min(len(u), len(v))
        differ = u[:most] != v[:most]
        if differ.any():
            return done + int(differ.argmax())
        done += most
        if most < size:
            return done
        size *= 4


def _root(x: np.ndarray, a: int, p: int) -> int:
    """The smallest divisor of ``p`` that is a period of the ``p`` words from ``a`` on."""
    q, rest, d = p, p, 2
    while rest > 1:
        if d * d > rest:
            d = rest
        if rest % d:
            d += 1
            continue
        while rest % d == 0:
            rest //= d
        while q % d == 0 and np.array_equal(x[a:a + p - q // d], x[a + q // d:a + p]):
            q //= d
    return q


def boundary_runs(x: np.ndarray, low: int, high: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """(p, a, e): words a to e - 1 equal those p further on, for every p of the octaves that is no multiple of a shorter period.

    ``x`` holds tiles one after the other, with a number of its own before, after
    and between them. Octave k has a boundary every 2^k words. The Z-function of
    a boundary c at p is how far the words from c on equal those from c + p on. A
    run with four periods has a boundary at which that is at least p, so only
    these count; there the match is followed to both ends. The function is taken
    for all boundaries and periods of the octave at once, word by word, and goes
    on where words have agreed so far.
    """
    known: list[tuple[int, int, int]] = []
    pad = np.arange(_PREFIX, dtype=np.int64) - (1 << 62)
    for k in range(low, high + 1):
        s = 1 << k
        if LEAST_PERIODS * s > longest:
            return
        m = (len(x) - s) // s + 1 if len(x) > s else 0
        wide = np.concatenate((x, pad, np.arange(s, dtype=np.int64) - (1 << 61)))
        at, r = np.nonzero(wide[s:s + m * s].reshape(m, s) == wide[:m * s:s, None])
        c, p = at * s, at.dtype.type(s) + r
        for t in range(1, min(s, _PREFIX)):
            if len(c) == 0:
                break
            same = wide[c + t] == wide[np.minimum(c + p + t, len(wide) - 1)]
            c, p = c[same], p[same]
        alive = np.ones(len(c), dtype=bool)

        def within(a: int, end: int, q: int, c=c, p=p, alive=alive) -> None:
            """Multiples of a known period inside its run are no runs of their own."""
            i, j = np.searchsorted(c, (a, end))
            alive[i:j] &= (p[i:j] % q != 0) | (c[i:j] + 2 * p[i:j] > end)

        known = [run for run in known if run[1] - run[0] >= 2 * s]
        for run in known:
            within(*run)
        for j in range(len(c)):
            if not alive[j]:
                continue
            place, period = int(c[j]), int(p[j])
            e = place + _agree(x, place, place + period, 1)
            if e - place < period:
                continue
            a = place - _agree(x, place - 1, place + period - 1, -1)
            q = _root(x, a, period)
            if q == period:
                yield period, a, e
            known.append((a, e + period, q))
            within(a, e + period, q)


def _least_match(p: int) -> int:
    return max(LEAST_WORDS - p, (LEAST_PERIODS - 1) * p)


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _TILES.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], schema=_TILES)


def _cut(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Tiles of all documents: words as numbers that are equal where words of one document are."""
    for part in by_bytes(batches, "text", _BATCH_BYTES):
        found, starts = words(part["text"])
        codes = found.dictionary_encode().indices.to_numpy().astype("<i4")
        rows, size = [], 0
        for key, x, y in zip(part["key"].to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            for low, high, a, b in _tiles(y - x, tile) if y - x >= LEAST_WORDS else ():
                rows.append((key, low, high, a, y - x, codes[x + a:x + b].tobytes()))
                size += b - a
                if size >= _SOLVED_WORDS:
                    yield _batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield _batch_of(rows)


def _solve(tiles: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, period, a, e``: matches inside each tile that are long enough, or that the tile cuts off."""
    for part in by_bytes(tiles, "codes", 4 * _SOLVED_WORDS):
        rows = sorted(zip(*(part[n].to_pylist() for n in _TILES.names), strict=True), key=lambda r: (r[1], r[2], -len(r[5])))
        out: list[tuple[str, int, int, int]] = []
        kinds: dict[tuple[int, int], list] = {}
        for row in rows:
            # Tiles of like size lie together, so that a large octave meets no small tile.
            size = (len(row[5]) // 4).bit_length()
            kinds.setdefault((row[1], min(row[2], size)), []).append(row)
        for (low, high), own in kinds.items():
            codes = [np.frombuffer(r[5], "<i4") for r in own]
            sizes = np.array([len(v) for v in codes])
            x = np.empty(int(sizes.sum()) + len(codes) + 1, dtype=np.int64)
            starts = np.cumsum(np.concatenate(([1], sizes[:-1] + 1)))
            x[np.concatenate((starts - 1, [len(x) - 1]))] = -1 - np.arange(len(codes) + 1)
            for at, v in zip(starts, codes, strict=True):
                x[at:at + len(v)] = v
            for p, a, e in boundary_runs(x, low, high, int(sizes.max())):
                i = int(np.searchsorted(starts, a, "right")) - 1
                key, _, _, first, total, _ = own[i]
                a, e = a - int(starts[i]), e - int(starts[i])
                cut_off = (a == 0 and first > 0) or (e + p == sizes[i] and first + sizes[i] < total)
                if cut_off or e - a >= _least_match(p):
                    out.append((key, p, first + a, first + e))
        if out:
            key, p, a, e = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), *[pa.array(v, pa.int64()) for v in (p, a, e)]],
                                             names=["key", "period", "a", "e"])


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id, text, key``: rows of one id and text share their key, and so their runs."""
    own = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return own.withColumn("key", F.sha2(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text")), 256))


def _runs(keyed: DataFrame, tile: int) -> DataFrame:
    """``key, start, length, period`` of every run."""
    own = keyed.select("key", "text")
    short = F.length("text") <= 2 * tile  # so at most `tile` words
    matches = "key string, period long, a long, e long"
    tiles = own.where(~short).mapInArrow(lambda rows: _cut(rows, tile), _TILES_SPARK).repartition("key", "low", "first")
    found = (own.where(short).mapInArrow(lambda rows: _solve(_cut(rows, tile)), matches)
             .unionByName(tiles.mapInArrow(_solve, matches)).distinct())
    before = Window.partitionBy("key", "period").orderBy("a", "e").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key", "period").orderBy("a", "e").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.coalesce((F.max("e").over(before) < F.col("a")), F.lit(True)).cast("int")
    whole = (found.withColumn("begins", begins).withColumn("part", F.sum("begins").over(upto))
             .groupBy("key", "period", "part").agg(F.min("a").alias("start"), F.max("e").alias("e")))
    match = F.col("e") - F.col("start")
    enough = match >= F.greatest(F.lit(LEAST_WORDS) - F.col("period"), F.lit(LEAST_PERIODS - 1) * F.col("period"))
    return whole.where(enough).select("key", "start", (match + F.col("period")).alias("length"), "period")


def runs(docs: DataFrame, text: str = "text", tile: int = TILE_WORDS) -> DataFrame:
    """``doc_id, text, start, length, period``: every run of every distinct (doc_id, text), see ``collapsed``."""
    keyed = _keyed(docs, text).distinct()
    return keyed.join(_runs(keyed, tile), "key").select("doc_id", "text", "start", "length", "period")


@F.pandas_udf(T.StringType())
def _collapse(texts: pd.Series, starts: pd.Series, lengths: pd.Series, periods: pd.Series) -> pd.Series:
    def kept(text: str, start, length, period) -> str:
        own = text.encode().split()  # of bytes, split() knows blank and \\x09-\\x0D only
        if start is not None and len(start):
            depth = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(depth, start + period, 1)
            np.add.at(depth, start + length, -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        return b" ".join(own).decode()

    return pd.Series([kept(*row) for row in zip(texts, starts, lengths, periods, strict=True)], dtype=object)


def collapsed(docs: DataFrame, text: str = "text", tile: int = TILE_WORDS) -> DataFrame:
    """``doc_id, runs, collapsed``: each document's runs, and its text with every run cut down to one period.

    Words are what blank and \\x09-\\x0D part, numbered from 0. A run is a stretch
    of words with smallest period q and a length of at least max(6, 4 q) that no
    neighbouring word extends; ``runs`` lists ``start, length, period`` by start,
    then period. A word goes if some run holds it after that run's first q words;
    the rest is joined by one blank. Null and empty texts have no runs and an
    empty ``collapsed``. Every row gives a row; rows of one doc_id with other
    texts have their own runs; a null doc_id stays null; other columns are not
    read.

    Documents of up to ``tile`` words are solved where they lie; longer ones are
    exploded into overlapping tiles for each period octave, which are dealt out.
    Matches are stitched by document and period, a document's own number of them
    in a group at most, and return to the texts by a join.
    """
    keyed = _keyed(docs, text)
    listed = _runs(keyed, tile).groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        "start", "length", "period"))).alias("runs")).withColumnRenamed("key", "of")
    rows = keyed.join(listed, F.col("key") == F.col("of"), "left")
    # The order by start, length, period becomes one by start, period: at one start a longer period is a longer run or another.
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    ordered = F.array_sort(F.coalesce("runs", none), lambda x, y: F.when(
        x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int"))
    rows = rows.withColumn("runs", ordered)
    return rows.select("doc_id", "runs", _collapse(
        "text", F.col("runs.start"), F.col("runs.length"), F.col("runs.period")).alias("collapsed"))
