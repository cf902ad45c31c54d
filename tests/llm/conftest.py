from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = (
    "block", "key", "size", "node", "text_", "n_words", "score", "target", "finish", "rank", "bucket",
    "component", "rep", "step", "label", "code", "links", "words", "lines", "_once", "_id", "_text",
)

LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
COPY = "the same text again and again in " + " ".join(f"part{i}" for i in range(120))
ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t ", None, "a", 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, COPY, "en", "b", len(COPY)),
    (5, COPY, "en", "b", len(COPY)),
    (6, COPY, "de", None, len(COPY)),
    (7, "short one", "en", "b", 9),
    (None, "without an id " + COPY, "en", "c", None),
    (None, None, None, None, None),
    (8, "short one", "en", "b", 9),
    (9, "é" * 700, "fr", "c", 700),
    (10, "x" * 500, "en", "c", 500),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD_ROWS, DOCS)
    return rows.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

