"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = "pieces-1"
ALPHA = 1.0                # power of the piece probabilities; smaller values sample more freely
SPACE = "▁"           # how the vocabulary writes a blank
_OFFSET = 2.7              # of the rank in Zipf's law
_FLUSH = 200_000           # chunks sampled at once
_TABLE_ARCS = 3_000_000    # the table of seen chunks starts anew beyond this size
_LEARN = 20_000            # new chunks filtered side by side
_SHARE_BITS = 40           # of a draw; states have the 23 bits above
_PART_ROWS, _PART_BYTES = 1024, 4_000_000  # rows and text taken from a batch at once


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbouring counters give unrelated numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces by number, and what each stands for in bytes."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor()
        self.sp.LoadFromSerializedProto(model)
        self.raw: list[bytes] = [b""] * self.sp.piece_size()
        self.usable = [not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i)) for i in range(len(self.raw))]
        for i in range(len(self.raw)):
            text = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.raw[i] = bytes([int(text[3:5], 16)])
            elif self.usable[i]:
                self.raw[i] = text.replace(SPACE, " ").encode()

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode()[1:]


class Lattice(Vocabulary):
    """The piece lattice of a vocabulary.

    The public vocabulary file gives merge ranks, no probabilities; a piece of
    rank r gets the probability of Zipf's law, 1 / (r + 2.7), scaled to one, and
    that to the power ``alpha`` is its weight. A character without a piece is
    written as the byte pieces of its UTF-8 form.

    Pieces never join a blank to what precedes it and never hold a line break,
    so a text falls into chunks that are segmented independently of each other.
    The filtered table of a chunk is made once and used wherever it recurs.
    """

    def __init__(self, model: bytes, alpha: float = ALPHA):
        super().__init__(model)
        sp, size = self.sp, len(self.raw)
        ranks = np.array([min(-sp.get_score(i), float(size)) for i in range(size)])
        usable = np.array(self.usable)
        mass = np.where(usable, 1.0 / (np.maximum(ranks, 0) + _OFFSET), 0.0)
        least = mass[usable].min()
        self.byte_ids = [0] * 256
        self.pieces: dict[str, int] = {}
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[self.raw[i][0]], mass[i] = i, least
            elif usable[i]:
                self.pieces[sp.id_to_piece(i)] = i
        self.weight = ((mass / mass.sum()) ** alpha).tolist()
        self.byte_weight = self.weight[self.byte_ids[0]]
        self.longest = max(map(len, self.pieces))
        joined = [p for p in self.pieces if len(p) > 1]
        apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in joined)
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+" if apart else "(?s).+")
        self._trie()
        self._clear()

    def _trie(self) -> None:
        """The pieces as a trie in arrays: an edge is (node, code point), found by bisection."""
        nodes: dict[str, int] = {"": 0}
        edges: dict[int, int] = {}
        ends = [-1]
        for text, piece in self.pieces.items():
            at = 0
            for n in range(1, len(text) + 1):
                key = at << 21 | ord(text[n - 1])
                at = edges.get(key, -1)
                if at < 0:
                    at = nodes[text[:n]] = edges[key] = len(ends)
                    ends.append(-1)
            ends[at] = piece
        keys = np.array(sorted(edges), dtype=np.int64)
        self.edge_keys = np.append(keys, np.iinfo(np.int64).max)
        self.edge_next = np.array([edges[k] for k in keys.tolist()] + [0], dtype=np.int64)
        self.ends = np.array(ends, dtype=np.int32)
        self.weights = np.array(self.weight)

    def _clear(self) -> None:
        self.known: dict[str, int] = {}       # chunk -> the state of its end
        self.states = 0
        # Of an arc: state + cumulative chance within it, rising over the whole table; the state it
        # comes from, -1 for the chunk's start; its piece, below -1 a character in bytes as -2 - code point.
        self.cum, self.prev, self.piece = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)

    def _arcs(self, codes: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, piece and weight of every arc of chunks laid end to end; ``stop`` is where a place's chunk ends."""
        at, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        starts, ends, pieces, single = [], [], [], np.zeros(len(codes), dtype=bool)
        for n in range(self.longest):
            inside = at + n < stop[at]
            at, node = at[inside], node[inside]
            key = node << 21 | codes[at + n]
            edge = np.searchsorted(self.edge_keys, key)
            found = self.edge_keys[edge] == key
            at, node = at[found], self.edge_next[edge[found]]
            if not len(at):
                break
            piece = self.ends[node]
            whole = piece >= 0
            starts.append(at[whole])
            ends.append(at[whole] + n + 1)
            pieces.append(piece[whole])
            if n == 0:
                single[at[whole]] = True
        bare = np.flatnonzero(~single)
        code = codes[bare]
        # Blank and its sign change places in chunks: a sign in the text is no blank and goes in bytes.
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF) + 2 * (code == 32)
        spelled = np.where((width == 1) & (code < 256), np.array(self.byte_ids)[np.minimum(code, 255)], -2 - code)
        piece = np.concatenate([*pieces, spelled]).astype(np.int32)
        weight = np.concatenate([*[self.weights[p] for p in pieces], self.byte_weight ** width])
        return np.concatenate([*starts, bare]), np.concatenate([*ends, bare + 1]), piece, weight

    def learn(self, chunks: list[str]) -> None:
        """Forward filtering of new chunks side by side: the chance of every arc, given that a segmentation passes its end.

        A place is filtered after all places before it in its chunk; masses are
        logarithms, so that long chunks keep their precision.
        """
        lengths = np.array([len(c) for c in chunks])
        stops = np.cumsum(lengths)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        first = np.repeat(stops - lengths, lengths)
        start, end, piece, weight = self._arcs(codes, np.repeat(stops, lengths))
        depth = end - first[end - 1]
        order = np.lexsort((start, end, depth))
        start, end, piece, weight, depth = start[order], end[order], piece[order], weight[order], depth[order]
        # log of the mass that reaches the end of each place; a chunk's start has mass one.
        mass, share = np.zeros(len(codes)), np.empty(len(start))
        log_weight = np.log(weight)
        rows = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
        for low, high in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
            s, e = start[low:high], end[low:high]
            reach = log_weight[low:high] + np.where(s > first[e - 1], mass[s - 1], 0.0)
            group = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
            sizes = np.diff(np.append(group, len(e)))
            top = np.maximum.reduceat(reach, group)
            part = np.exp(reach - np.repeat(top, sizes))
            total = np.add.reduceat(part, group)
            mass[e[group] - 1] = top + np.log(total)
            share[low:high] = part / np.repeat(total, sizes)
        order = np.argsort(end, kind="stable")
        start, end, piece, share = start[order], end[order], piece[order], share[order]
        group = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
        sizes = np.diff(np.append(group, len(end)))
        upto = share.copy()
        for j in range(1, int(sizes.max())):  # added up within each end, so that other chunks leave no trace
            at = group[sizes > j] + j
            upto[at] += upto[at - 1]
        # State and share in one whole number: a draw never leaves its state by rounding.
        scaled = np.minimum(np.rint(upto * 2.0 ** _SHARE_BITS), 2.0 ** _SHARE_BITS).astype(np.int64)
        scaled[group + sizes - 1] = 1 << _SHARE_BITS
        base = self.states
        self.cum = np.concatenate((self.cum, ((base + end - 1).astype(np.int64) << _SHARE_BITS) + scaled))
        self.prev = np.concatenate((self.prev, np.where(start > first[end - 1], base + start - 1, -1).astype(np.int32)))
        self.piece = np.concatenate((self.piece, piece))
        self.known.update(zip(chunks, (base + stops - 1).tolist(), strict=True))
        self.states += len(codes)

    def split(self, text: str) -> list[str]:
        """Chunks of the text with a blank set before it; blanks and their sign change places."""
        if SPACE in text:
            text = text.translate({32: 0x2581, 0x2581: 32})
        else:
            text = text.replace(" ", SPACE)
        return self.chunks.findall(SPACE + text)

    def sample(self, ends: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling of many chunks side by side: pieces a chunk, and all pieces in reading order.

        The draw for the n-th piece from a chunk's end hangs on the chunk's seed and n alone.
        """
        cum, prev, piece = self.cum, self.prev, self.piece
        counts = np.zeros(len(ends), dtype=np.int64)
        who, state, steps, n = np.arange(len(ends)), ends, [], 0
        while len(who):
            draw = _mix(seeds[who] + np.uint64((n * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
            u = (draw >> np.uint64(64 - _SHARE_BITS)).astype(np.int64)
            arc = np.searchsorted(cum, (state.astype(np.int64) << _SHARE_BITS) + u, side="right")
            steps.append((who, piece[arc]))
            counts[who] += 1
            state = prev[arc]
            on = state >= 0
            who, state, n = who[on], state[on], n + 1
        stop = np.cumsum(counts)
        out = np.empty(int(stop[-1]) if len(stop) else 0, dtype=np.int32)
        for n, (who, ids) in enumerate(steps):
            out[stop[who] - 1 - n] = ids
        return counts, out

    def _bytes_for(self, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spells out characters that stand as code points."""
        spelled, more = [], np.zeros(len(ids), dtype=np.int64)
        at = np.flatnonzero(ids < -1)
        for i in at:
            code = -2 - int(ids[i])
            spelled.append([self.byte_ids[b] for b in (SPACE if code == 32 else chr(code)).encode()])
            more[i] = len(spelled[-1]) - 1
        place = np.arange(len(ids)) + np.cumsum(more) - more
        out = np.repeat(ids, more + 1)
        for i, group in zip(at, spelled, strict=True):
            out[place[i]:place[i] + len(group)] = group
        owner = np.repeat(np.arange(len(counts)), counts)
        return counts + np.bincount(owner, weights=more, minlength=len(counts)).astype(np.int64), out

    def encode_many(self, texts: list[str | None], keys: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, pieces) in order, in slices: for a slice the row numbers, the pieces of each, and all pieces.

        A row may go on in the next slice.
        """
        chunks, seeds, rows = [], [], []
        for row, (text, key) in enumerate(zip(texts, keys, strict=True)):
            if text is None:
                continue
            own = self.split(text)
            seed = np.uint64(xxhash.xxh64_intdigest(str(key)))
            draws = _mix(seed + np.arange(len(own), dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
            for at in range(0, len(own), _FLUSH):
                chunks += own[at:at + _FLUSH]
                seeds.append(draws[at:at + _FLUSH])
                rows.append((row, len(seeds[-1])))
                if len(chunks) >= _FLUSH:
                    yield self._flush(chunks, seeds, rows)
                    chunks, seeds, rows = [], [], []
        if rows:
            yield self._flush(chunks, seeds, rows)

    def _flush(self, chunks: list[str], seeds: list, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = self.known
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        for at in range(0, len(new), _LEARN):
            self.learn(new[at:at + _LEARN])
        ends = np.fromiter(map(known.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        counts, ids = self.sample(ends, np.concatenate(seeds))
        if len(ids) and ids.min() < -1:
            counts, ids = self._bytes_for(counts, ids)
        owner = np.repeat(np.arange(len(rows)), [n for _, n in rows])
        per_row = np.bincount(owner, weights=counts, minlength=len(rows)).astype(np.int64)
        if len(self.cum) > _TABLE_ARCS:
            self._clear()
        return np.array([r for r, _ in rows]), per_row, ids


@functools.lru_cache(maxsize=2)
def _lattice(model: bytes, alpha: float) -> Lattice:
    """One per Python worker, for all tasks that it runs; a task's table of seen chunks ends with it."""
    return Lattice(model, alpha)


@functools.lru_cache(maxsize=2)
def _vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of bounded text (or a single row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > _PART_BYTES or i - start >= _PART_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def _model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _decoded(vocabulary: Vocabulary, lists: pa.ListArray) -> pa.StringArray:
    return pa.array([vocabulary.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists], type=pa.string())


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, model_path: str = MODEL, alpha: float = ALPHA, seed: str = SEED,
           decoded: str | None = None) -> DataFrame:
    """Adds ``pieces``, a sampled segmentation of each whole text, seeded by doc_id.

    With ``decoded`` the pieces are also decoded in the same pass, into a column of that name.

    The same id, text, seed and alpha give the same pieces, however rows are
    batched or dealt. A null text has null pieces; an empty text has the pieces
    of the blank that every text is given in front. A column that is already
    called ``pieces`` (or as ``decoded`` says) is replaced. The vocabulary file is read once by the
    driver and sent along (half a megabyte).
    """
    model = _model(model_path)
    added = ["pieces", decoded] if decoded else ["pieces"]
    schema = _with_column(docs.schema, "pieces", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = _with_column(schema, decoded, T.StringType())
    kept = [f.name for f in schema.fields if f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model, alpha)
        try:
            for batch in batches:
                for part in _parts(batch, "text"):
                    yield encoded(lattice, part)
        finally:
            lattice._clear()

    def encoded(lattice: Lattice, part: pa.RecordBatch) -> pa.RecordBatch:
        texts, ids = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("text", "doc_id"))
        sizes, found = np.zeros(len(texts), dtype=np.int64), [np.empty(0, np.int32)]
        for rows, counts, new in lattice.encode_many(texts, [f"{seed}:{i}" for i in ids]):
            np.add.at(sizes, rows, counts)
            found.append(new)
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        mask = pa.array([t is None for t in texts], type=pa.bool_())
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)), mask=mask)
        new = [lists]
        if decoded:
            new.append(_decoded(lattice, lists))
        return pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in kept], *new], [*kept, *added])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str = MODEL, out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text that ``pieces`` stand for; null pieces give null. A column of that name is replaced."""
    model = _model(model_path)
    schema = _with_column(encoded.schema, out, T.StringType())
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pieces"))
            for start in range(0, batch.num_rows, 256):
                part, own = batch.slice(start, 256), lists.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in kept], _decoded(vocabulary, own)], [*kept, out])

    return encoded.mapInArrow(run, schema)
