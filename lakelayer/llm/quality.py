r"""Quality classifier by co-training of two views.

* Text view: shares of symbols, capitals, digits, bars and exclamation marks, distinct
  words and lines, words that repeat the word before, mean word length, taken over the
  whole text.
* Metadata view: source, language, length.

Each view is a naive Bayes model over binned features. It is learned from the labels
(smallest label wins where a document has several); then, for ``ROUNDS`` rounds, each
view names the unlabelled documents of which it is confident and the other view learns
from these beside the labels. Pseudo-labels come from all unlabelled documents. A view's
output is calibrated (Platt) on the label fold that learning leaves out (``FOLDS``); only
calibrated confidence makes a pseudo-label, so a weak view gives none. The calibrated log odds of both views add
up to the score.

The documents are read once: their bins, a few integers each, go to the shared scratch
folder, and every round is one aggregate over them. Only counts per bin (a fixed number
of bins) reach the driver, so learning uses all rows at any size. Everything is
DataFrame functions.

Defined cases: a null text counts as empty; null source, language or length has a bin
of its own; without labels, or with one class only, the score is 0.5 and every document
is accepted; null ids are scored and never labelled; repeated rows give repeated results;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import register, table

ROUNDS = 2
CONFIDENT = 0.98
ACCEPT = 0.25  # a document goes only when it is three times as likely to be bad
FOLDS = 5
SYMBOLS = "#$%&*~^<>{}[]=_\\@"
CAPITALS = "".join(chr(c) for c in (*range(65, 91), *range(192, 215), *range(216, 223)))
WORD_GAP = r"[\x20\x09-\x0D]+"
LOGIT_LIMIT = 12.0  # raw log odds are calibrated within


@dataclass(frozen=True)
class Feature:
    name: str
    size: int
    bin: Column  # 0 .. size - 1


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _log_bin(x: Column, size: int) -> Column:
    return F.least(F.floor(F.log2(x + 1)).cast("int"), F.lit(size - 1))


def _hash_bin(c: Column, size: int) -> Column:
    return F.when(c.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(c), F.lit(size - 1)).cast("int"))


def _text_features() -> list[Feature]:
    t = F.col("body")
    count = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    share_of = lambda name, part, whole: Feature(name, 12, _log_bin(_share(part, whole) * 1000, 12))
    share = lambda name, chars: share_of(name, count(chars), F.length(t))
    words, lines = F.col("words"), F.col("lines")
    n = F.size(words)
    distinct = F.floor(_share(F.size(F.array_distinct(words)), n) * 10).cast("int")
    return [
        share("symbols", SYMBOLS), share("capitals", CAPITALS), share("digits", "0123456789"),
        share("bars", "|"), share("shouts", "!"),
        Feature("distinct_words", 16 * 11, _log_bin(n, 16) * 11 + distinct),
        share_of("echoes", F.size(F.filter(F.zip_with(words, F.slice(words, 2, n), lambda a, b: a == b), lambda x: x)), n),
        Feature("distinct_lines", 11, F.floor(_share(F.size(F.array_distinct(lines)), F.size(lines)) * 10).cast("int")),
        Feature("word_length", 16, F.least(F.floor(_share(F.length(t), n)).cast("int"), F.lit(15))),
    ]


def _metadata_features() -> list[Feature]:
    n = F.coalesce(F.greatest(F.col("n_chars"), F.lit(0)).cast("double"), F.lit(-0.5))
    return [
        Feature("source", 513, _hash_bin(F.col("source"), 513)),
        Feature("lang", 129, _hash_bin(F.col("lang"), 129)),
        Feature("length", 34, F.when(F.col("n_chars").isNull(), 33).otherwise(_log_bin(n, 33))),
    ]


VIEWS = {"text": _text_features, "meta": _metadata_features}


def _size(view: str) -> int:
    return sum(f.size for f in VIEWS[view]())


def _bins(view: str) -> Column:
    """The view's bins as positions in one weight array."""
    out, start = [], 0
    for f in VIEWS[view]():
        out.append(F.lit(start) + f.bin)
        start += f.size
    return F.array(*out).alias(view)


def _binned(docs: DataFrame) -> DataFrame:
    """doc (all columns of ``docs``), text and meta (arrays of bin positions)."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "source", "lang", "n_chars", body.alias("body"))
    split = rows.select("*", F.split("body", WORD_GAP).alias("words"), F.split("body", "\n").alias("lines"))
    return split.select("doc", _bins("text"), _bins("meta"))


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and meta (arrays of bin positions), y (0, 1 or null), held (fold left out)."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").cast("int").alias("y")))
    binned = _binned(docs.select("doc_id", "text", "source", "lang", "n_chars")).select("doc.doc_id", "text", "meta")
    return binned.join(known, binned["doc_id"] == known["_labelled"], "left").select(
        "doc_id", "text", "meta", "y", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0).alias("held"))


def _learn(rows: DataFrame, view: str, target: str) -> list[float]:
    """Naive Bayes log odds: the prior, then a weight per bin. ``rows`` has ``target`` 0 or 1."""
    counted = rows.where(F.col(target).isNotNull()).select(
        F.col(target).alias("k"), F.explode(F.concat(F.array(F.lit(-1)), view)).alias("bin"))
    n = {(r["k"], r["bin"]): r["count"] for r in counted.groupBy("k", "bin").count().collect()}  # a row per bin
    total = [n.get((k, -1), 0) for k in (0, 1)]
    if not min(total):
        return [0.0] * (1 + _size(view))
    weights = [math.log(total[1] / total[0])]
    for f, start in _layout(view):
        for b in range(start, start + f.size):
            p = [(n.get((k, b), 0) + 1) / (total[k] + f.size) for k in (0, 1)]
            weights.append(math.log(p[1] / p[0]))
    return weights


def _layout(view: str) -> list[tuple[Feature, int]]:
    out, start = [], 0
    for f in VIEWS[view]():
        out.append((f, start))
        start += f.size
    return out


def _logit(view: str, weights: list[float]) -> Column:
    at = F.lit(weights[1:])
    return F.aggregate(view, F.lit(weights[0]), lambda acc, b: acc + F.get(at, b))


def _calibrate(rows: DataFrame, logits: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Per view (slope, offset): log odds of class 1 are slope * raw + offset, fitted by Platt's
    method on the labels left out."""
    out = {}
    for view, logit in logits.items():
        got = rows.where(F.col("held") & F.col("y").isNotNull()).groupBy(
            _rounded(logit).alias("x"), "y").count().collect()  # a row per rounded value and class
        out[view] = platt([(r["x"], r["y"], r["count"]) for r in got])
    return out


def platt(points: list[tuple[float, int, int]], turns: int = 50) -> tuple[float, float]:
    """Logistic regression of y on x over (x, y, count), with Platt's targets in place of 0 and 1."""
    n = [sum(c for _, y, c in points if y == k) for k in (0, 1)]
    target = (1 / (n[0] + 2), (n[1] + 1) / (n[1] + 2))
    slope, offset = 0.0, math.log((n[1] + 1) / (n[0] + 1))
    if not min(n):
        return 0.0, 0.0
    for _ in range(turns):
        g = [0.0, 0.0]
        h = [1e-6, 0.0, 1e-6]
        for x, y, c in points:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * x + offset))))
            e, w = c * (p - target[y]), c * p * (1 - p)
            g = [g[0] + e * x, g[1] + e]
            h = [h[0] + w * x * x, h[1] + w * x, h[2] + w]
        det = h[0] * h[2] - h[1] * h[1]
        step = ((h[2] * g[0] - h[1] * g[1]) / det, (h[0] * g[1] - h[1] * g[0]) / det)
        size = max(1.0, abs(step[0]), abs(step[1]))  # no step over 1
        slope, offset = slope - step[0] / size, offset - step[1] / size
        if max(map(abs, step)) < 1e-9:
            break
    return max(slope, 0.0), offset


def _rounded(logit: Column) -> Column:
    return F.least(F.greatest(F.round(logit * 4) / 4, F.lit(-LOGIT_LIMIT)), F.lit(LOGIT_LIMIT))


@dataclass(frozen=True)
class Model:
    weights: dict[str, list[float]]  # per view
    calibration: dict[str, tuple[float, float]]
    prior: float

    def odds(self, view: str) -> Column:
        """Calibrated log odds over the column of the view's bins."""
        slope, offset = self.calibration[view]
        return _rounded(_logit(view, self.weights[view])) * slope + offset

    def scores(self) -> list[Column]:
        """text_score, meta_score, score over the columns text and meta (0 to 1, high is good)."""
        odds = {v: self.odds(v) for v in VIEWS}
        sigmoid = lambda x: 1 / (1 + F.exp(-x))
        return [*(sigmoid(odds[v]).alias(f"{v}_score") for v in VIEWS),
                sigmoid(odds["text"] + odds["meta"] - F.lit(self.prior)).alias("score")]


def learn(rows: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT) -> Model:
    """Co-training over the rows of ``features``."""
    taught = rows.withColumn("_t", F.when(~F.col("held"), F.col("y")))
    weights = {v: _learn(taught, v, "_t") for v in VIEWS}
    prior = weights["meta"][0]
    fitted = lambda: Model(weights, _calibrate(rows, {v: _logit(v, weights[v]) for v in VIEWS}), prior)
    edge = math.log(confident / (1 - confident))
    for _ in range(rounds):
        model = fitted()
        sure = {v: F.when(model.odds(v) >= edge, 1).when(model.odds(v) <= -edge, 0) for v in VIEWS}
        weights = dict(weights)
        for view, teacher in (("meta", "text"), ("text", "meta")):
            pseudo = taught.withColumn("_t", F.when(F.col("y").isNull(), sure[teacher]).otherwise(F.col("_t")))
            weights[view] = _learn(pseudo, view, "_t")
    return fitted()


def _read_once(docs: DataFrame, labels: DataFrame) -> DataFrame:
    path = scratch_path(docs.sparkSession, "quality")
    features(docs, labels).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, text_score, meta_score, score, accepted for every document."""
    rows = _read_once(docs, labels)
    return rows.select("doc_id", *learn(rows).scores()).withColumn("accepted", F.col("score") >= accept)


def keep_accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` without the rejected ones; all columns stay. The model is applied as the documents
    pass, so none is shuffled."""
    model = learn(_read_once(docs, labels))
    return _binned(docs).select("doc", model.scores()[-1]).where(F.col("score") >= accept).select("doc.*")


@register("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
