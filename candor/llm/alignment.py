"""Tokens of two vocabularies over one text: which overlap, where both end, and how often ids meet corpus-wide."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.blocks import by_bytes
from candor.session import scratch_path

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how the byte vocabulary cuts text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"              # how the piece vocabulary writes a blank
BLOCK_BYTES = 1_500_000  # of text that are aligned at once; a longer text is a block of its own

Ragged = tuple[np.ndarray, np.ndarray]  # values of all rows, and where each row's begin


def _ragged(rows: list[list[int]]) -> Ragged:
    ends = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))
    return (np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(ends[-1]) if len(ends) else 0),
            np.concatenate((np.zeros(1, dtype=np.int64), ends)))


class ByteVocabulary:
    """A byte-level vocabulary from its JSON file. Ids follow the order of merges, which is verified."""

    def __init__(self, file: bytes):
        model = json.loads(file)["model"]
        # Byte-level vocabularies write a byte that has no visible character as the next one from U+0100 on.
        shown = {b for b in range(256) if chr(b).isprintable() and b != 0x20}
        hidden = iter(range(256, 512))
        byte = {chr(b) if b in shown else chr(next(hidden)): b for b in range(256)}
        vocabulary = model["vocab"]
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ids = [vocabulary[a + b] for a, b in merges]
        if ids != sorted(ids) or (ids and ids[0] < 256):
            raise ValueError("ids of this vocabulary do not follow its merges")
        # What no merge makes is a special token; its string in a text is ordinary text.
        made = set(ids)
        ranks = {token: i for token, i in ranks.items() if len(token) == 1 or i in made}
        self._encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.raw = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.raw[i] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + t) for t in texts]


class PieceVocabulary:
    """A SentencePiece vocabulary from its model file; it puts the blank before a text by itself."""

    def __init__(self, file: bytes):
        self._sp = sentencepiece.SentencePieceProcessor()
        self._sp.LoadFromSerializedProto(file)
        n = self._sp.piece_size()
        text = [self._sp.id_to_piece(i) for i in range(n)]
        if any(SPACE in t.lstrip(SPACE) for t in text):
            raise ValueError("pieces of this vocabulary join a blank to what precedes it")
        self.raw = [bytes([int(t[3:5], 16)]) if self._sp.is_byte(i) else t.replace(SPACE, " ").encode()
                    for i, t in enumerate(text)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._sp.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=4)
def _byte_vocabulary(file: bytes) -> ByteVocabulary:
    return ByteVocabulary(file)


@functools.lru_cache(maxsize=4)
def _piece_vocabulary(file: bytes) -> PieceVocabulary:
    return PieceVocabulary(file)


def _loose(unit: str) -> bool:
    return unit == "" or unit[0].isspace() or unit[-1].isspace()


def _units(texts: list[str]) -> tuple[list[str], Ragged]:
    """Distinct pieces of text that both vocabularies encode by themselves, and each text as a row of them.

    Neither joins a blank to what precedes it, and white space looks no further
    than white space goes: so a single blank between two other characters is a
    place where a text may be cut. A text with a blank elsewhere stays whole.
    """
    parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = parts.values.dictionary_encode()
    units: list[str] = coded.dictionary.to_pylist()
    starts, codes = parts.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64)
    loose = np.fromiter(map(_loose, units), dtype=bool, count=len(units))[codes]
    whole = np.flatnonzero(np.add.reduceat(np.append(loose, False), starts[:-1])) if len(texts) else []
    if len(whole) == 0:
        return units, (codes, starts)
    rows = np.split(codes, starts[1:-1])
    for i in whole.tolist():
        rows[i] = np.array([len(units)])
        units.append(texts[i])
    return units, (np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows]))))


def _gather(table: Ragged, rows: Ragged) -> Ragged:
    """The rows of numbers that ``rows`` of row numbers stand for."""
    values, starts = table
    sizes = np.diff(starts)[rows[0]]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[:-1][rows[0]] - (ends - sizes), sizes)
    return values[at], np.concatenate((np.zeros(1, dtype=np.int64), ends))[rows[1]]


class Aligned:
    """The tokens of a list of texts in both vocabularies, laid out one text after the other.

    ``a`` and ``b`` are token ids with the texts' borders, ``starts_*`` and
    ``ends_*`` byte places over all texts, ``whole`` tells whose bytes came back
    as blank + text from both; the others, and empty texts, have no tokens.
    """

    def __init__(self, texts: list[str], a: ByteVocabulary, b: PieceVocabulary):
        units, rows = _units(texts)
        wanted = [(" " + u).encode() for u in units]
        sides, sound = [], np.array([len(u) > 0 for u in units], dtype=bool)
        for vocabulary in (a, b):
            encoded = vocabulary.encode(units)
            raw = vocabulary.raw
            sound &= np.fromiter((b"".join([raw[i] for i in ids]) == w for ids, w in zip(encoded, wanted, strict=True)),
                                 dtype=bool, count=len(units))
            sides.append(_ragged(encoded))
        broken = np.add.reduceat(np.append(~sound[rows[0]], False), rows[1][:-1]) if len(texts) else np.zeros(0)
        self.whole = broken == 0
        kept = np.repeat(self.whole, np.diff(rows[1]))
        sizes = np.where(self.whole, np.diff(rows[1]), 0)
        rows = rows[0][kept], np.concatenate(([0], np.cumsum(sizes)))
        self.a, self.b = _gather(sides[0], rows), _gather(sides[1], rows)
        self.starts_a, self.ends_a = self._places(self.a[0], a.raw)
        self.starts_b, self.ends_b = self._places(self.b[0], b.raw)
        self.of_a = np.repeat(np.arange(len(texts)), np.diff(self.a[1]))
        self.of_b = np.repeat(np.arange(len(texts)), np.diff(self.b[1]))

    @staticmethod
    def _places(ids: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))[ids]
        ends = np.cumsum(lengths)
        return ends - lengths, ends

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and B tokens of every overlapping pair.

        Of two tokens that overlap, one starts inside the other: each start looks
        up the last start of the other side in its document, and the pairs of both
        directions are united; those with one start in common come from both.
        """
        left = pd.DataFrame({"at": self.starts_a, "doc": self.of_a})
        right = pd.DataFrame({"at": self.starts_b, "doc": self.of_b})
        covers_a = pd.merge_asof(left, right.assign(by=np.arange(len(right))), on="at", by="doc")["by"].to_numpy(np.int64)
        covers_b = pd.merge_asof(right, left.assign(by=np.arange(len(left))), on="at", by="doc")["by"].to_numpy(np.int64)
        new = np.flatnonzero(self.starts_a[covers_b] != self.starts_b)
        return np.concatenate((np.arange(len(left)), covers_b[new])), np.concatenate((covers_a, new))

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """For each A and B token whether a group ends with it: both sides end there."""
        both = np.zeros(int(self.ends_a[-1]) + 1 if len(self.ends_a) else 1, dtype=bool)
        both[self.ends_b] = True
        last_a = both[self.ends_a]
        both[:] = False
        both[self.ends_a] = True
        return last_a, both[self.ends_b]

    def written_groups(self, last_a: np.ndarray, last_b: np.ndarray) -> Iterator[str]:
        """Per text ``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        top_a, top_b = (int(x[0].max(initial=0)) + 1 for x in (self.a, self.b))
        table = np.array([f"{i}," for i in range(top_a)] + [f"{i}|" for i in range(top_a)]
                         + [f"{i}," for i in range(top_b)] + [f"{i};" for i in range(top_b)], dtype=object)
        n_a, n_b = len(last_a), len(last_b)
        # A group's A tokens stand after the B tokens of earlier groups, its B tokens after its own A tokens.
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        laid = np.empty(n_a + n_b, dtype=np.int64)
        laid[np.arange(n_a) + np.concatenate(([0], upto_b))[group_a]] = self.a[0] + top_a * last_a
        laid[np.arange(n_b) + upto_a[group_b]] = 2 * top_a + self.b[0] + top_b * last_b
        for x, y in zip(self.a[1][:-1] + self.b[1][:-1], self.a[1][1:] + self.b[1][1:], strict=True):
            yield "".join(table[laid[x:y]])[:-1]


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of neighbouring rows with up to ``most`` bytes of text."""
    for part in by_bytes(batches, "text", most):
        yield part["doc_id"].to_pylist(), [t or "" for t in part["text"].to_pylist()]


def _files(byte_vocabulary: str, piece_model: str) -> tuple[bytes, bytes]:
    with open(byte_vocabulary, "rb") as a, open(piece_model, "rb") as b:
        return a.read(), b.read()


def overlaps(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> DataFrame:
    """``doc_id, a_at, a, b_at, b``: every overlapping pair of tokens with their places in the document and their ids.

    Texts that are null, empty or do not come back as blank + text give none.
    """
    files = _files(byte_vocabulary, piece_model)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _byte_vocabulary(files[0]), _piece_vocabulary(files[1])
        for ids, texts in _blocks(batches, BLOCK_BYTES):
            found = Aligned(texts, a, b)
            x, y = found.links()
            of = found.of_a[x]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()).take(pa.array(of)), pa.array(x - found.a[1][of], pa.int64()), pa.array(found.a[0][x]),
                pa.array(y - found.b[1][of], pa.int64()), pa.array(found.b[0][y])], names=["doc_id", "a_at", "a", "b_at", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        pairs, "doc_id long, a_at long, a int, b_at long, b int")


def groups(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> DataFrame:
    """``doc_id, groups``: the ids between places where tokens of both sides end, as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    files = _files(byte_vocabulary, piece_model)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _byte_vocabulary(files[0]), _piece_vocabulary(files[1])
        for ids, texts in _blocks(batches, BLOCK_BYTES):
            found = Aligned(texts, a, b)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(
                found.written_groups(*found.groups()), pa.string())], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        written, "doc_id long, groups string")


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.array([values[x:y].tobytes() for x, y in zip(starts[:-1], starts[1:], strict=True)], pa.binary())


_NARROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("linked", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_NARROW_SPARK = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "linked binary, times binary, pairs array<long>, counts array<long>")


def link_statistics(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> DataFrame:
    """Per document how its tokens in both vocabularies meet, and how common its links are corpus-wide.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``:
    an id pair counts as often as links corpus-wide hold it; ``n_best`` are links
    whose pair counts most of all pairs with that B id, ties included;
    ``count_sum`` adds up the counts over the document's links. A null or empty
    text, or one that does not come back as blank + text (a written ``▁`` does
    not), has zeros and an empty digest. Every row gives a row, repeated ones
    too; a null doc_id stays null; other columns are not read.

    Documents are aligned in blocks of bounded text. A block keeps a dictionary
    of its id pairs, so a pair is shuffled once a block, not once a link, and
    documents hold numbers of that dictionary. Pair counts then return to the
    blocks that asked. The one broadcast has a row for each B id.
    """
    spark, files = docs.sparkSession, _files(byte_vocabulary, piece_model)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _byte_vocabulary(files[0]), _piece_vocabulary(files[1])
        part = TaskContext.get().partitionId() << 32
        for at, (ids, texts) in enumerate(_blocks(batches, BLOCK_BYTES)):
            found, n = Aligned(texts, a, b), len(texts)
            x, y = found.links()
            codes, pairs = pd.factorize((found.a[0][x].astype(np.int64) << 32) | found.b[0][y])
            of = found.of_a[x]
            # Distinct pairs of each document, and how many of its links hold them.
            own, times = np.unique(of * max(len(pairs), 1) + codes, return_counts=True)
            starts = np.searchsorted(own, np.arange(n + 1) * max(len(pairs), 1))
            last_a, last_b = found.groups()
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.written_groups(last_a, last_b)]
            counted = np.concatenate(([0], np.cumsum(last_a)))
            none = pa.nulls(n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part + at)), pa.array(ids, pa.int64()), pa.array(np.diff(found.a[1])),
                pa.array(np.diff(found.b[1])), pa.array(np.diff(counted[found.a[1]])), pa.array(np.bincount(of, minlength=n)),
                pa.array(digests, pa.string()), _packed((own % max(len(pairs), 1)).astype("<i4"), starts),
                _packed(times.astype("<i4"), starts), none, none], schema=_NARROW)
            yield pa.RecordBatch.from_pylist([{"block": part + at, "pairs": pairs, "counts": np.bincount(codes, minlength=len(pairs))}],
                                             schema=_NARROW)

    path = scratch_path(spark, "aligned")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        aligned, _NARROW_SPARK).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(_NARROW_SPARK).parquet(path)

    used = blocks.where("pairs IS NOT NULL").select(
        "block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "x")).select("block", "at", "x.pairs", "x.counts")
    counts = used.groupBy("pairs").agg(F.sum("counts").alias("n")).withColumn("b", F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))  # at most one row for each id of B
    judged = counts.join(most, "b").select("pairs", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = used.select("block", "at", "pairs").join(judged, "pairs").select(F.col("block").alias("asker"), "at", "n", "best")

    def summed(rows: pa.Table, told: pa.Table) -> pa.Table:
        size = told.num_rows
        n, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        at = told["at"].to_numpy()
        n[at], best[at] = told["n"].to_numpy(), told["best"].to_numpy(zero_copy_only=False)
        linked = [np.frombuffer(x, "<i4") for x in rows["linked"].to_pylist()]
        times = [np.frombuffer(x, "<i4").astype(np.int64) for x in rows["times"].to_pylist()]
        both = zip(linked, times, strict=True)
        sums = np.array([(n[x] @ t, best[x] @ t) for x, t in both], dtype=np.int64).reshape(-1, 2)
        return (rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
                .append_column("n_best", pa.array(sums[:, 1])).append_column("count_sum", pa.array(sums[:, 0])))

    return (blocks.where("pairs IS NULL").drop("pairs", "counts").groupBy("block").cogroup(answers.groupBy("asker"))
            .applyInArrow(summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                  "n_best long, count_sum long")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
