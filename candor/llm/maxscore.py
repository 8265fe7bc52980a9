"""Exact top-k inner products by MaxScore over sharded postings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.session import stored

TOP = 20
SCALE = 64
QUERY_STEP = 20
SHARD_ROWS = 8192    # candidates a shard is meant to hold
BLOCK_ROWS = 2048    # queries a block is meant to hold
FIRST_ROWS = 4096    # the longest vectors, which give every query its first threshold
_CHUNK = 256         # queries that a shard is traversed for at once
_PROBE = 8           # further terms before the next pruning, then twice as many
_SPARSE = 0.02       # share of rows that can still compete, from which on they are probed one by one
_PAIRS = 50_000      # of them at once
_MOST_TASKS = 20_000


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component as doubles; unusable vectors are left out.

    A vector takes no part if it is null or holds a null, NaN or infinite
    component, or if its id is null.
    """
    v = rows[vector].cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.where(rows.vec_id.isNotNull() & v.isNotNull() & F.coalesce(sound, F.lit(False)))
            .select(rows.vec_id.cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v")))


class Postings:
    """The candidates of one shard, a column of weights for each term, with the bounds of every column."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: list[np.ndarray], width: int):
        matrix = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            matrix[i, :len(v)] = v
        order = np.argsort(ids, kind="stable")
        self.ids, self.numbers, self.rows = ids[order], numbers[order], matrix[order]
        self.high = self.rows.max(axis=0, initial=-np.inf)
        self.low = self.rows.min(axis=0, initial=np.inf)

    def search(self, queries: np.ndarray, own: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of up to ``k`` best rows of each query, among them all that can be of the best overall.

        ``own`` is the number of each query's own row, which is left out, and
        ``limits`` a score that ``k`` rows of the whole table are known to reach.
        Every term has an upper bound on what it adds. The terms with the largest
        bounds are essential: the rest together cannot lift a row over the limit.
        Essential columns are traversed for all rows, for many queries at once,
        and so are the next ones while many rows can still reach the limit; the
        others are probed only for the few rows that can.
        """
        upper = np.maximum(queries * self.high, queries * self.low)
        floor = np.minimum(queries * self.high, queries * self.low)
        spread = upper - floor
        order = np.argsort(-spread, axis=1, kind="stable")
        ranked = np.take_along_axis(spread, order, axis=1)
        still = floor.sum(axis=1)[:, None] + np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1]
        cut = (still >= limits[:, None]).sum(axis=1)  # of each query's terms so many are essential
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(queries.shape[1])[None, :], axis=1)
        essential = rank < cut[:, None]
        score = np.where(essential, queries, 0.0) @ self.rows.T
        q, at = np.nonzero(own[:, None] == self.numbers[None, :])
        score[q, at] = -np.inf
        if score.shape[1] > 4 * k:
            # The rows ahead so far, scored in full, may raise the limit.
            best = np.argpartition(-score, 4 * k - 1, axis=1)[:, :4 * k]
            whole = np.einsum("qd,qrd->qr", queries, self.rows[best])
            whole[np.isneginf(np.take_along_axis(score, best, axis=1))] = -np.inf
            limits = np.maximum(limits, np.partition(whole, 3 * k, axis=1)[:, 3 * k])
        done, step = cut, _PROBE
        while True:
            rest = np.where(rank < done[:, None], 0.0, upper).sum(axis=1)
            competitive = score >= (limits - rest)[:, None]
            if int(done.min()) >= queries.shape[1] or np.count_nonzero(competitive) <= _SPARSE * score.size:
                break
            # Still many: the next terms are traversed for all rows as well.
            part = (rank >= done[:, None]) & (rank < (done + step)[:, None])
            score += np.where(part, queries, 0.0) @ self.rows.T
            done, step = np.minimum(done + step, queries.shape[1]), 2 * step
        q, at = np.nonzero(competitive)
        own_row = np.isneginf(score[q, at])
        q, at = q[~own_row], at[~own_row]
        found = np.concatenate([np.empty(0), *[np.einsum("pd,pd->p", queries[q[x:x + _PAIRS]], self.rows[at[x:x + _PAIRS]])
                                               for x in range(0, len(q), _PAIRS)]])
        keep = found >= limits[q]
        q, at, found = q[keep], at[keep], found[keep]
        # Rows lie in order of their ids, so ties go to the smaller one.
        ahead = np.lexsort((at, -found, q))
        q, at, found = q[ahead], at[ahead], found[ahead]
        first = np.searchsorted(q, q, "left")
        top = np.arange(len(q)) - first < k
        return q[top], at[top], found[top]


def _bucket(c: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(11)), F.lit(n)).cast("int")


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS, first_rows: int = FIRST_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows by inner product, its own left out.

    ``vectors(vec_id, v)`` holds whole numbers as doubles; inner products must
    stay below 2^53 to be exact, else it raises. A shorter vector counts zeros in
    the missing places. Ties go to the smaller vec_id; fewer candidates than
    ``k`` are all returned. Every row is a candidate of its own, and a query of
    its own: of repeated rows and rows that share a vec_id each meets the others.

    Each query first learns a score that ``k`` rows reach, from ``first_rows``
    rows with the longest vectors, the one thing that the driver passes on.
    Candidates are dealt into shards and queries into blocks by a hash, both by
    row counts, so copies of one vector spread over all shards. Every (block,
    shard) pair is a bounded number of rows: MaxScore returns at most ``k`` rows a
    query, which a ranking with early limits merges.
    """
    numbered = vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("q", F.coalesce(is_query, F.lit(False)))
    own = stored(numbered, "vectors")
    size = own.agg(F.count("*").alias("rows"), F.count_if("q").alias("queries"), F.max(F.greatest(
        F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0.0))).alias("most"), F.max(F.size("v")).alias("width")).first()
    if size.rows and size.most ** 2 * max(size.width, 1) >= 2.0 ** 53:
        raise ValueError("inner products of these vectors are too large to be exact")
    width = max(size.width or 0, 1)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    longest = own.select("row", "v").orderBy(F.desc(norm), "row").limit(first_rows).toPandas()
    head, head_rows = _matrix(list(longest["v"]), width), longest["row"].to_numpy(np.int64)

    def with_limits(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            limits = []
            for x in range(0, len(part), _CHUNK):
                some = part.iloc[x:x + _CHUNK]
                score = _matrix(list(some["v"]), width) @ head.T
                score[some["row"].to_numpy()[:, None] == head_rows[None, :]] = -np.inf
                limits.append(np.full(len(some), -np.inf) if score.shape[1] < k else
                              np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k])
            yield part.assign(limit=np.concatenate([*limits, np.empty(0)]))

    shards, blocks = -(-size.rows // shard_rows) or 1, -(-size.queries // block_rows) or 1
    tasks = min(4 * shards * blocks, _MOST_TASKS)
    queries = own.where("q").select("row", "vec_id", "v").mapInPandas(
        with_limits, "row long, vec_id long, v array<double>, limit double")
    left = (queries.withColumn("block", _bucket(F.col("row"), blocks))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(tasks, "block", "shard"))
    right = (own.select("row", "vec_id", "v").withColumn("shard", _bucket(F.col("row"), shards))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "block", "shard"))

    def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64),) * 3 + (np.empty(0),)]
        if len(queries) and len(rows):
            lists = Postings(rows["vec_id"].to_numpy(), rows["row"].to_numpy(), list(rows["v"]), width)
            for x in range(0, len(queries), _CHUNK):
                some = queries.iloc[x:x + _CHUNK]
                numbers = some["row"].to_numpy()
                q, at, score = lists.search(_matrix(list(some["v"]), width), numbers, some["limit"].to_numpy(), k)
                out.append((numbers[q], some["vec_id"].to_numpy()[q], lists.ids[at], score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query_row", "query_id", "vec_id", "score"), columns, strict=True))).astype("int64")

    found = (left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
             .applyInPandas(best, "query_row long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
