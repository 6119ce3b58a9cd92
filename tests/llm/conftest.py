from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use inside; documents may have columns of these names.
CLASHING = ("batch", "part", "row", "h", "body", "words", "lines", "sid", "label", "size", "keep_id", "_keep_id", "_gone",
            "_leaked", "_h", "_n", "_bucket", "score", "rank", "held_out", "ids", "meta")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, lang, source]) as documents; ``clash`` adds columns with clashing names."""

    def make(rows, clash=False):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s0")), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clash:
            from pyspark.sql import functions as F

            df = df.select("*", *(F.lit("x").alias(c) for c in CLASHING))
        return df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null, empty and very long texts, nulls in other columns, repeated rows, ties, ids beyond 2^53."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [
        (1, None, None, None), (2, "", "en", None), (3, "   \n\t ", None, "s1"), (4, "one", "en", "s1"),
        (None, "a row without an id, of some words here", "en", "s1"), (9_007_199_254_740_993, "big id big id", "de", "s2"),
        (6, "same text twice in two rows of the same id", "en", "s1"), (6, "same text twice in two rows of the same id", "en", "s1"),
        (7, "same text twice in two rows of the same id", "en", "s1"), (8, long_text, "en", "s1"), (9, long_text + " end", "en", "s1"),
        (10, "x" * 200_000, "fr", "s3"), (11, "9" * 60_000, "fr", "s3"), (12, "▁ \x00 é 日本 \U0001f600", "fr", "s3"),
    ]
