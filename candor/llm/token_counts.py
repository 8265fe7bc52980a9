"""Token counts that follow edits: segment trees over pre-tokens, re-encoded only where an edit reaches."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this public vocabulary cuts text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64        # pre-tokens a leaf is built with
CONTEXT = 3      # characters beyond its end that can change a pre-token: two of a contraction, one of a look-ahead
_CACHE = 500_000

EDITS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("removed", T.LongType()), T.StructField("added", T.StringType())]))


class Counter:
    """Tokens of a pre-token, remembered: byte pair merges never cross pre-tokens."""

    def __init__(self, ranks: bytes):
        lines = (line.split() for line in ranks.splitlines() if line)
        self._encoding = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                                           mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})
        self.cut = regex.compile(PATTERN)
        self._seen: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        n = self._seen.get(piece)
        if n is None:
            # Longer ones are rare and not worth keeping.
            n = len(self._encoding.encode_ordinary(piece))
            if len(piece) <= 32:
                if len(self._seen) >= _CACHE:
                    self._seen.clear()
                self._seen[piece] = n
        return n

    def whole(self, text: str) -> int:
        return len(self._encoding.encode_ordinary(text))


@functools.lru_cache(maxsize=2)
def _counter(ranks: bytes) -> Counter:
    return Counter(ranks)


class DocumentTree:
    """The pre-tokens of one text under a segment tree of characters and tokens.

    Leaves hold runs of pre-tokens, at first ``LEAF`` each; inner nodes hold the
    sums of their halves in an array. An edit finds its leaf by the character
    sums, cuts the text anew from a border that it cannot reach, until a new
    border meets an old one behind it, and updates the sums on the way up.
    """

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.reencoded = text, counter, 0
        pieces = counter.cut.findall(text)
        self._build([len(p) for p in pieces], [counter(p) for p in pieces])

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = [(chars[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(chars), LEAF)] or [([], [])]
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size, self.chars, self.tokens = size, [0] * (2 * size), [0] * (2 * size)
        for i, (c, t) in enumerate(self.leaves):
            self.chars[size + i], self.tokens[size + i] = sum(c), sum(t)
        for node in range(size - 1, 0, -1):
            self._pull(node)

    def _pull(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def pieces(self) -> int:
        return sum(len(c) for c, _ in self.leaves)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf with the character at ``place`` (the last one behind the end), and where it starts."""
        node, start = 1, 0
        while node < self.size:
            left = self.chars[2 * node]
            if place < start + left or not self.chars[2 * node + 1]:
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        return node - self.size, start

    def edit(self, start: int, removed: int, added: str) -> None:
        """Replaces ``removed`` characters at ``start`` by ``added``; places beyond the text mean its end."""
        start = min(max(start, 0), len(self.text))
        removed = min(max(removed, 0), len(self.text) - start)
        if not removed and not added:
            return
        old, shift = self.text, len(added) - removed
        self.text = old[:start] + added + old[start + removed:]
        first, left = self._leaf_at(max(0, start - CONTEXT))
        chars, tokens = self.leaves[first]
        # Pre-tokens of this leaf that end well before the edit stay.
        keep, at = 0, left
        while keep < len(chars) and at + chars[keep] + CONTEXT <= start:
            at += chars[keep]
            keep += 1
        new_chars, new_tokens = chars[:keep], tokens[:keep]
        # Old borders behind the edit, leaf by leaf, as places in the new text.
        leaf, index, border = first, keep, at
        stop = start + removed
        place, end, text = at, len(self.text), self.text
        while place < end:
            piece = self.counter.cut.match(text, place).group()
            place += len(piece)
            new_chars.append(len(piece))
            new_tokens.append(self.counter(piece))
            self.reencoded += len(piece)
            if place >= start + len(added):
                while leaf < len(self.leaves) and (border < stop or border + shift < place):
                    if index == len(self.leaves[leaf][0]):
                        leaf, index = leaf + 1, 0
                    else:
                        border += self.leaves[leaf][0][index]
                        index += 1
                if border >= stop and border + shift == place:
                    break
        else:
            leaf, index = len(self.leaves), 0
        rest = ([], [])
        if leaf < len(self.leaves):
            rest = self.leaves[leaf][0][index:], self.leaves[leaf][1][index:]
        self.leaves[first] = new_chars + rest[0], new_tokens + rest[1]
        for i in range(first + 1, min(leaf + 1, len(self.leaves))):
            self.leaves[i] = [], []
        self._update(first, min(leaf, len(self.leaves) - 1))
        if len(self.leaves[first][0]) > 8 * LEAF:
            self._build([c for cs, _ in self.leaves for c in cs], [t for _, ts in self.leaves for t in ts])

    def _update(self, low: int, high: int) -> None:
        for i in range(low, high + 1):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
        low, high = (low + self.size) // 2, (high + self.size) // 2
        while low:
            for node in range(low, high + 1):
                self._pull(node)
            low, high = low // 2, high // 2


_COUNTS = [("n_tokens", T.LongType()), ("edited_tokens", T.LongType()), ("n_pretokens", T.LongType()),
           ("reencoded_chars", T.LongType()), ("edited", T.StringType())]


def edited_counts(docs: DataFrame, edits: str = "edits", ranks_path: str = RANKS) -> DataFrame:
    """Adds token counts before and after a row's edits, and the edited text.

    ``docs`` has ``text`` and an array column of ``struct(start, removed,
    added)``, applied in order, each to the text that the one before left.
    Added columns: ``n_tokens``, ``edited_tokens``, ``n_pretokens`` (before),
    ``reencoded_chars`` (what all edits together cut anew) and ``edited``; columns of these
    names are replaced. Null texts count as empty and null edits as none; null
    places count as 0, a null addition as empty. Each row stands alone, so
    repeats are counted alike. The vocabulary file is read once by the driver
    and sent along (under a megabyte).
    """
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    kept = [c for c in docs.columns if c not in dict(_COUNTS)]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, k) for n, k in _COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, changes = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("text", edits))
                out = []
                for text, steps in zip(texts, changes, strict=True):
                    tree = DocumentTree(text or "", counter)
                    before, pieces = tree.total, tree.pieces
                    for e in steps or ():
                        if e is not None:
                            tree.edit(e["start"] or 0, e["removed"] or 0, e["added"] or "")
                    out.append((before, tree.total, pieces, tree.reencoded, tree.text))
                new = [pa.array([r[i] for r in out], type=pa.string() if i == 4 else pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in kept], *new], schema.names)

    return docs.select(*kept).mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Attaches an edit table ``(doc_id, seq, start, removed, added)`` as an array in the order of ``seq``.

    Documents without edits get null. The edits of one document are applied by
    one task in any case; they are gathered before the texts are joined.
    """
    gathered = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "removed", "added"))).alias("all"))
    steps = F.transform("all", lambda e: F.struct(e["start"].cast("long").alias("start"),
                                                  e["removed"].cast("long").alias("removed"), e["added"].alias("added")))
    return docs.join(gathered.select("doc_id", steps.alias("edits")), "doc_id", "left")


def standard_edits(text: Column, doc_id: Column) -> Column:
    """Four edits made from a text itself: words taken out, a passage moved to the front, a word joined, a line added.

    Places come from a hash of doc_id, so they differ between documents.
    """
    n = F.length(text).cast("long")
    place = [F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(0)), F.lit(i)), F.greatest(n, F.lit(1))) for i in range(3)]
    def change(start: Column, removed: int, added: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(removed).cast("long").alias("removed"), added.alias("added"))

    return F.array(change(place[0], 40, F.lit("")),
                   change(F.lit(0).cast("long"), 0, F.substring(text, place[1].cast("int") + 1, F.lit(60))),
                   change(place[2], 1, F.lit("'re")),
                   change(n + 30, 0, F.lit("\n  Revised: 2024 ")))
