from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    def build(texts, **columns):
        """Documents 0, 1, ... of the given texts; other columns by name."""
        rows = [(i, t, *[(columns.get(c) or [None] * len(texts))[i] for c in ("lang", "source")], len(t or ""))
                for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return build
