from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: Columns that clash with names used inside of operators.
CLASHING = (
    "key rep n band sig blocks node up loads hash slots position _s _guest _id _text _b host path "
    "good evidence keep shard slot size item_id class_id _rule _hash _sub mean"
).split()

LONG = " ".join(f"word{i % 977} runs{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the usual and with clashing columns."""

    def make(rows, source="src0"):
        df = spark.createDataFrame(
            [(i, t, "en", source, len(t or "")) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        ).repartition(3)
        return df.withColumns({c: F.lit("clash") for c in CLASHING})

    return make


@pytest.fixture(scope="session")
def messy(make_docs):
    """Missing ids and texts, empty, blank and very long texts, repeated rows."""
    return make_docs([
        (1, "a plain text of a few words, nothing more"), (2, None), (3, ""), (4, "  \n\t "),
        (5, LONG), (6, "a plain text of a few words, nothing more"),
        (7, "twice"), (7, "twice"), (None, "no id"), (None, None), (8, "ñandú 日本語 😀 \x00 end"),
        (9, "x"), (10, "7" * 5000),
    ])


def plain(df, *names):
    """Rows as tuples, sorted, whatever is missing."""
    rows = [tuple(r[n] for n in names) for r in df.select(*names).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
