from __future__ import annotations

import pytest

from freshhaul.llm.common import settle

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two"),
    (5, "One  two\n"),
    (5, "One  two\n"),
    (None, "one two"),
    (6, LONG),
    (7, LONG + " "),
    (8, "naïve 漢字 🙂 text\x85here\u00a0and there"),
]


@pytest.fixture
def frame(spark):
    """Documents with every odd case, and columns whose names the operators use themselves."""

    def make(rows, extra=True):
        rows = [(i, t, "en", f"s{k % 3}" if k else None, len(t or "")) for k, (i, t) in enumerate(rows)]
        docs = spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
        )
        if extra:
            for name in ("row", "row_file", "row_index", "size", "digest", "score", "key", "n", "doc"):
                docs = docs.selectExpr("*", f"'x' AS {name}")
        return settle(docs, "test-docs")

    return make


@pytest.fixture
def odd(frame):
    return frame(ODD)


@pytest.fixture
def nothing(frame):
    return frame(ODD).filter("doc_id < 0")
