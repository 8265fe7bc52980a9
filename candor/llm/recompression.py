"""Substring deduplication by recompression: texts are parsed by content, shared symbols reveal repeats, windows verify them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.blocks import by_bytes, words
from candor.session import scratch_path

WINDOW = 13              # words that have to repeat
ROUNDS = 4               # of pairing; a symbol then covers three words on average
BLOCK_BYTES = 4_000_000  # of text that are parsed at once; a longer text is a block of its own
BUCKET_BYTES = 4_000_000  # of text for which one task compares symbols or windows

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_SYMBOL_BITS = _U(48)    # of a symbol's name that are compared: they only choose what is verified
_CHECK_BITS = _U(24)     # of a second name of a window, beside 64 of the first


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: like numbers give unlike ones."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Level:
    """The symbols of one round, in order: name, words [start, end), and the words [left, right) that make it so.

    Wherever the same words stand from ``left`` to ``right``, the same symbol
    stands among them. Beside a text's border these places lie beyond it.
    """

    def __init__(self, name: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.name, self.start, self.end, self.left, self.right = name, start, end, left, right


def _runs(level: Level, opens: np.ndarray, ends: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
    """Equal neighbours become one symbol. It stands on both neighbours, which end the run."""
    again = np.concatenate(([False], level.name[1:] == level.name[:-1])) & ~opens
    at = np.flatnonzero(~again)
    upto = np.append(at[1:], len(again))
    count = upto - at
    name = np.where(count > 1, _mixed(level.name[at] * _U(31) + count.astype(_U)), level.name[at])
    opens, ends = opens[at], ends[upto - 1]
    start, end = level.start[at], level.end[upto - 1]
    left, right = start - 1, end + 1  # of single words; at a text's border these are another text's
    return Level(name, start, end, left, right), opens, ends


def _pairs(level: Level, opens: np.ndarray, ends: np.ndarray, number: int) -> tuple[Level, np.ndarray, np.ndarray]:
    """Names fall into two classes, by a bit; a first followed by a second becomes one symbol.

    So a first stands on what follows it, a second on what precedes it.
    """
    second = (_mixed(level.name + _U(number * int(_ODD) % (1 << 64))) >> _U(63)).astype(bool)
    left, right = level.left.copy(), level.right.copy()
    np.copyto(right[:-1], level.right[1:], where=~second[:-1] & ~ends[:-1])
    np.copyto(left[1:], level.left[:-1], where=second[1:] & ~opens[1:])
    right[~second & ends] = level.end[~second & ends] + 1
    left[second & opens] = level.start[second & opens] - 1
    # A text's last symbol already stands on the border after the first round; keep the farther place.
    np.maximum(right, level.right, out=right)
    np.minimum(left, level.left, out=left)
    joined = np.concatenate((~second[:-1] & second[1:] & ~ends[:-1], [False]))
    at = np.flatnonzero(~np.concatenate(([False], joined[:-1])))
    two = joined[at]
    last = at + two
    name = np.where(two, _mixed(level.name[at] * _ODD + level.name[last]), level.name[at])
    return Level(name, level.start[at], level.end[last], left[at], right[last]), opens[at], ends[last]


def parsed(names: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """The levels of texts that lie one after the other; ``starts`` are their borders. Names tell content alone."""
    n = len(names)
    place = np.arange(n)
    levels = [Level(names, place, place + 1, place, place + 1)]
    opens, ends = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    full = np.diff(starts) > 0
    opens[starts[:-1][full]] = True
    ends[starts[1:][full] - 1] = True
    level, opens, ends = _runs(levels[0], opens, ends)
    levels.append(level)
    for number in range(1, rounds + 1):
        level, opens, ends = _pairs(level, opens, ends, number)
        levels.append(level)
    return levels


def revealing(levels: list[Level], at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each window that begins at a word of ``at`` the name of what reveals it.

    The first symbol of the highest level that the window's own words make, with
    the next one if they make that too. Equal windows have equal names.
    """
    n = len(levels[0].name)
    out = np.zeros(len(at), dtype=_U)
    open_, left = np.arange(len(at)), at
    for number, level in reversed(list(enumerate(levels))):
        before = np.cumsum(np.bincount(level.left + 1, minlength=n + 2))
        k = before[left]
        last = len(level.name) - 1
        held = (k <= last) & (level.right[np.minimum(k, last)] <= left + window)
        k, own = k[held], open_[held]
        after = np.minimum(k + 1, last)
        two = (after > k) & (level.right[after] <= left[held] + window)
        first = level.name[k]
        out[own] = np.where(two, _mixed(first * _ODD + _U(number) + level.name[after] * _U(3)), first)
        open_, left = open_[~held], left[~held]
        if len(open_) == 0:
            break
    return out


def _packed(values: np.ndarray) -> bytes:
    """Numbers by bytes of like rank, so that what neighbours share packs well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T).view("<u8").reshape(-1).astype(_U)


def _sorted_in(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=_U(0)))


def _sorted_out(data: memoryview, n: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, n), dtype=_U)


class Block:
    """Documents that are parsed together, and the windows in them that lie in one document with an id."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        self.ids, self.texts = ids, texts
        self.words, self.starts = words(texts)
        coded = self.words.dictionary_encode()
        digests = b"".join([xxhash.xxh3_128_digest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()])
        both = np.frombuffer(digests, "<u8").reshape(-1, 2)[coded.indices.to_numpy()].astype(_U)
        self.first, self.second = np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])
        sizes = np.diff(self.starts)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.owner = np.where(known, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), 0)
        counts = np.where(known, np.maximum(sizes - WINDOW + 1, 0), 0)
        ends = np.cumsum(counts)
        self.of = np.repeat(np.arange(len(sizes)), counts)  # the document of each window
        self.at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[:-1] - (ends - counts), counts)
        self.names = np.zeros(0, dtype=_U)
        if len(self.at):
            self.names = revealing(parsed(self.first, self.starts), self.at) >> (_U(64) - _SYMBOL_BITS)

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct names that reveal windows, and whether documents of several ids hold them."""
        order = np.argsort(self.names, kind="stable")
        name, owner = self.names[order], self.owner[self.of[order]]
        opens = np.flatnonzero(np.concatenate((np.ones(min(1, len(name)), dtype=bool), name[1:] != name[:-1])))
        return name[opens], np.minimum.reduceat(owner, opens) < np.maximum.reduceat(owner, opens) if len(opens) else np.zeros(0, bool)

    def asked(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that a shared symbol reveals: their two names by order, smallest owners, and each one's places."""
        at = np.flatnonzero(np.isin(self.names, shared))
        first, second = np.zeros(len(at), dtype=_U), np.zeros(len(at), dtype=_U)
        for i in range(WINDOW):
            x = self.at[at] + i
            first = _mixed(first * _ODD + self.first[x])
            second = _mixed(second * _ODD + self.second[x])
        second >>= _U(64) - _CHECK_BITS
        order = np.lexsort((second, first))
        first, second, at = first[order], second[order], at[order]
        new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        opens = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), dtype=bool), new)))
        least = np.minimum.reduceat(self.owner[self.of[at]], opens) if len(opens) else np.zeros(0, np.int64)
        return first[opens], second[opens], least, at, np.append(opens, len(at))


_ROWS = "block long, bucket int, n int, base long, payload binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("base", pa.int64()), ("payload", pa.binary())])


def _shut(parts: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _opened(payload: bytes) -> memoryview:
    return memoryview(zstandard.ZstdDecompressor().decompress(payload))


def _dealt(block: int, first: np.ndarray, bits: int, buckets: int, base: int, *more: np.ndarray) -> Iterator[tuple]:
    """Rows for the buckets of ``first``, which is sorted, has so many bits, and is cut into even ranges of names."""
    share = (1 << bits) // buckets + 1
    edges = np.searchsorted(first, np.array([min(i * share, (1 << bits) - 1) for i in range(1, buckets)], dtype=_U))
    for i, (x, y) in enumerate(zip([0, *edges], [*edges, len(first)], strict=True)):
        if y > x:
            yield block, i, int(y - x), base, _shut([_sorted_in(first[x:y]), *[_packed(m[x:y]) for m in more]])


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > 4_000_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in held], schema=_SCHEMA)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in held], schema=_SCHEMA)


def _table(rows: Iterator[tuple]) -> pa.Table:
    return pa.Table.from_batches(_batches(rows), schema=_SCHEMA)


def _kept(ids: pa.Array, texts: pa.Array) -> bytes:
    """Rows as bytes, and as a block again with ``_restored``."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids, texts.cast(pa.large_string())], names=["id", "text"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return _shut([sink.getvalue().to_pybytes()])


def _restored(payload: bytes) -> Block:
    with pa.ipc.open_stream(pa.py_buffer(_opened(payload))) as rows:
        table = rows.read_all().combine_chunks()
    column = {n: table[n].combine_chunks() for n in ("id", "text")}
    return Block(column["id"], column["text"])


def _shared(asks: pa.Table) -> pa.Table:
    """Of the symbols asked for in one range of names those that several blocks hold, a flag each, for every block."""
    n = asks["n"].to_numpy()
    parts = [_sorted_out(_opened(p.as_py()), k) for p, k in zip(asks["payload"], n.tolist(), strict=True)]
    _, of, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    flags = np.split(times[of] > 1, np.cumsum(n)[:-1])
    return _table((b, i, int(k), 0, np.packbits(f).tobytes()) for b, i, k, f in zip(
        asks["block"].to_pylist(), asks["bucket"].to_pylist(), n, flags, strict=True))


def _least(asks: pa.Table) -> pa.Table:
    """Of the windows asked for in one range of names the smallest owner, for every block that knows a larger one only."""
    n = asks["n"].to_numpy()
    firsts, seconds, owners = [], [], []
    for payload, k, base in zip(asks["payload"], n.tolist(), asks["base"].to_pylist(), strict=True):
        data = _opened(payload.as_py())
        firsts.append(_sorted_out(data, k))
        seconds.append(_unpacked(data[8 * k:], k))
        owners.append(_unpacked(data[16 * k:], k).astype(np.int64) + base)
    first, second, owner = map(np.concatenate, (firsts, seconds, owners))
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    opens = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    least = np.empty(len(owner), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], opens), np.diff(np.append(opens, len(a))))
    ends = np.cumsum(n)

    def rows() -> Iterator[tuple]:
        for block, bucket, x, y in zip(asks["block"].to_pylist(), asks["bucket"].to_pylist(), ends - n, ends, strict=True):
            better = least[x:y] < owner[x:y]
            if better.any():
                told = least[x:y][better]
                base = int(told.min())
                yield block, -1 - bucket, int(y - x), base, _shut([np.packbits(better).tobytes(), _packed((told - base).view(_U))])

    return _table(rows())


def _told_shared(block: Block, answers: dict[int, tuple]) -> np.ndarray:
    """The block's symbols that documents of several ids hold."""
    name, own = block.symbols()
    flags = [np.unpackbits(np.frombuffer(payload, np.uint8), count=n) for i, (n, _, payload) in sorted(answers.items()) if i >= 0]
    return name[own | np.concatenate(flags).astype(bool)] if flags else name[:0]


def _answers(rows: pa.Table) -> dict[int, tuple]:
    return {i: (n, base, payload) for i, n, base, payload in zip(*(rows[c].to_pylist() for c in _SCHEMA.names[1:]), strict=True)}


def repeats_removed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without the passages that a document of a smaller id holds too.

    Words are what blank and \\x09-\\x0D part. A word goes if some 13 consecutive
    words of its document that hold it also stand in a document with a smaller
    doc_id; all windows are judged on the input. What is left is joined by one
    blank. Null and empty texts have no words; texts under 13 words stay; rows
    that share a doc_id lose nothing to each other; a row without a doc_id has no
    smaller one and is none: it stays whole. Every row gives a row; other columns
    are not read.

    Recompression parses all texts alike: equal words of a run, then pairs chosen
    by their names, become symbols, round after round. A name is a digest of
    content, so it is the same in every task, and a symbol stands wherever the
    words stand that make it. First round of messages: every block of documents
    asks which of the symbols that reveal its windows other blocks hold as well.
    Only windows revealed by shared symbols go into the second one, with 88 bits
    of their words, and learn the smallest doc_id that holds them.

    A symbol or window is asked for once a block, however often it stands there,
    and names are dealt out by ranges, so no copy group and no frequent passage
    gathers in one task. The driver sees one sum of bytes.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // BUCKET_BYTES + 1

    def first_asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            part = TaskContext.get().partitionId() << 32
            for at, batch in enumerate(by_bytes(batches, "text", BLOCK_BYTES)):
                ids, texts = batch["doc_id"], batch["text"]
                yield part + at, None, len(ids), 0, _kept(ids, texts)
                yield from _dealt(part + at, Block(ids, texts).symbols()[0], int(_SYMBOL_BITS), buckets, 0)

        yield from _batches(rows())

    path = scratch_path(spark, "recompressed")
    own.mapInArrow(first_asks, _ROWS).write.option("compression", "none").parquet(path)

    def stored(which: str) -> DataFrame:
        return spark.read.schema(_ROWS).parquet(path).where(which)

    def second_asks(state: pa.Table, told: pa.Table) -> pa.Table:
        def rows() -> Iterator[tuple]:
            for at, payload in zip(state["block"].to_pylist(), state["payload"], strict=True):
                block = _restored(payload.as_py())
                first, second, least, _, _ = block.asked(_told_shared(block, _answers(told)))
                base = int(least.min()) if len(least) else 0
                yield from _dealt(at, first, 64, buckets, base, second, (least - base).view(_U))

        return _table(rows())

    shared_path, least_path = scratch_path(spark, "shared"), scratch_path(spark, "least")
    stored("bucket IS NOT NULL").groupBy("bucket").applyInArrow(_shared, _ROWS).write.parquet(shared_path)
    told = spark.read.schema(_ROWS).parquet(shared_path)
    asks = (stored("bucket IS NULL").groupBy("block").cogroup(told.withColumnRenamed("block", "asker").groupBy("asker"))
            .applyInArrow(second_asks, _ROWS))
    asks.groupBy("bucket").applyInArrow(_least, _ROWS).write.parquet(least_path)
    both = told.unionByName(spark.read.schema(_ROWS).parquet(least_path)).withColumnRenamed("block", "asker")

    def remove(state: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for payload in state["payload"]:
            block, answers = _restored(payload.as_py()), _answers(told)
            first, _, least, at, opens = block.asked(_told_shared(block, answers))
            done = 0
            for i in sorted((i for i in answers if i < 0), reverse=True):
                n, base, data = answers[i]
                # Buckets are ranges of the first name, in order; one without an answer holds nothing better.
                share = (1 << 64) // buckets + 1
                done = int(np.searchsorted(first, _U(min((-1 - i) * share, (1 << 64) - 1)))) if i < -1 else 0
                data = _opened(data)
                flags = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8)), count=n).astype(bool)
                better = _unpacked(data[-(-n // 8):], int(flags.sum())).view(np.int64) + base
                least[done:done + n][flags] = better
            smaller = np.repeat(least, np.diff(opens)) < block.owner[block.of[at]]
            begins = block.at[at[smaller]]
            depth = np.zeros(len(block.words) + 1, dtype=np.int64)
            np.add.at(depth, begins, 1)
            np.add.at(depth, begins + WINDOW, -1)
            stays = np.cumsum(depth[:-1]) == 0
            kept = np.concatenate(([0], np.cumsum(stays)))[block.starts]
            left = block.words.filter(pa.array(stays))
            lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), left)
            texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            sizes = np.diff(block.starts)
            out.append(pa.Table.from_arrays([block.ids, pa.array(sizes), pa.array(sizes - np.diff(kept)), texts],
                                            names=["doc_id", "n_words", "n_removed", "kept"]))
        return pa.concat_tables(out)

    return stored("bucket IS NULL").groupBy("block").cogroup(both.groupBy("asker")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept string")
