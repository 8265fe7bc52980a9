"""Slices of Arrow batches by size of text, and words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with about ``most`` bytes in ``column``; a longer row stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // most)) + 1 if len(sizes) else []
        for x, y in zip([0, *cut], [*cut, len(sizes)], strict=True):
            if y > x:
                yield batch.slice(x, y - x)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where each text's begin: what blank and \\x09-\\x0D part. A null text has none."""
    bare = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(bare)
    sizes = np.diff(lists.offsets.to_numpy()) - pc.equal(bare, "").to_numpy(zero_copy_only=False)
    found = lists.values
    return found.filter(pc.not_equal(found, "")), np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))
