"""Language identification by compression.

Each language gets a raw-content zstandard dictionary: text of that language. A
document is compressed whole with every dictionary; the language whose dictionary
gives the fewest bytes wins, and a narrow margin between the best two sets
``rejected``. Only letters count: every run of other characters becomes one space and
case is folded, in dictionaries and documents alike.

Learning: the only bounded part. For each language the ``sample_docs`` training
documents with the smallest hash give their first ``sample_chars`` characters to the
dictionary. The sample is drawn by two ranking windows (inside salted parts of a
language, then over the few survivors), so a language with most of the rows is
split. Predictions read the whole text of every document and nothing else.

Defined cases: null text, or text without a letter: ``und`` with score 0, not
rejected. No training document at all: every prediction is ``und``. A null
``doc_id`` is never learned from and counts as held out. Ties between languages (as
for texts of a word or two, which no dictionary shortens) go to the language with
more training documents, then to the first name. Repeated rows give repeated results; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import map_batches, texts
from .registry import register, table

SAMPLE_DOCS = 128
SAMPLE_CHARS = 2000
LEVEL = 6
MARGIN = 0.005
SCALE = 0.01
SALTS = 64
UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


def _folded(text: str) -> str:
    return _NO_LETTERS.sub(" ", text).lower()


def _remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def learn_dictionaries(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
                       sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Language -> dictionary content, at most ``sample_docs * sample_chars`` characters
    each; languages with more training documents come first."""
    rows = docs.where((_remainder() != 0) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", F.substring("text", 1, sample_chars).alias("part"), F.xxhash64("doc_id", "text").alias("_h"))
    salted = Window.partitionBy("lang", F.pmod("_h", F.lit(SALTS))).orderBy("_h", "part")
    whole = Window.partitionBy("lang").orderBy("_h", "part")
    picked = (rows.withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= sample_docs)
              .withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= sample_docs)
              .select("lang", "part", "_n").collect())  # bounded by the sample
    frequent = {r["lang"]: -r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    content: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (frequent[r["lang"]], r["lang"], -r["_n"])):
        content.setdefault(r["lang"], []).append(_folded(r["part"]))
    return {lang: "\n".join(parts).encode() for lang, parts in content.items()}


class Compressors:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL) -> None:
        self.langs = list(dictionaries)
        self.by_lang = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.by_lang.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False))

    def predict(self, text: str, margin: float = MARGIN) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        data = _folded(text).encode()
        sizes = [len(c.compress(data)) for c in self.by_lang]
        best = min(sizes)
        second = sorted(sizes)[1] if len(sizes) > 1 else math.inf
        # a softmax over the sizes; a hundredth more bytes is one unit
        score = 1 / sum(math.exp(-(s - best) / (SCALE * best)) for s in sizes)
        return self.langs[sizes.index(best)], score, second - best < margin * best


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    rows = docs.select("doc_id", F.coalesce(_remainder() == 0, F.lit(True)).alias("held_out"), "text")
    ready: list[Compressors] = []  # one per Python worker and query

    def score(b: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Compressors(dictionaries))
        found = [ready[0].predict(t, margin) for t in texts(b)]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
            ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return map_batches(rows, score, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, "
                                    "score double, rejected boolean")


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn_dictionaries(docs))
