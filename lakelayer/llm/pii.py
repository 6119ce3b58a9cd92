r"""Information-theoretic sanitisation of personal data.

1. Protected entities are found in every whole text by four fixed patterns (email,
   ip, card, phone), leftmost and non-overlapping per kind.
2. Terms (words of letters, lower-cased) within ``WINDOW`` terms of an entity are
   its context. From the whole corpus, with N term occurrences in all, m(e) of them in
   contexts of entity e, c(t) of term t and co(e, t) of t in contexts of e:

       IC(e)     = log2(N / m(e))                    what naming e reveals
       PMI(e, t) = log2(co(e, t) * N / (m(e) * c(t)))   what seeing t reveals of e
       disclosure(e, t) = PMI / IC                   1: t occurs only around e

3. A term that discloses some entity is removed (``disclosure >= REMOVE_AT``) or
   generalised (``>= GENERALISE_AT``) wherever it occurs outside entities, in every text,
   also in those that do not name the entity; the strongest action counts. A pair needs
   ``MIN_SUPPORT`` occurrences, as one meeting shows no association: every word that
   occurs once, beside an entity, has disclosure 1.

All counts cover all rows. Contexts are written to the shared scratch folder once;
pair counts and term counts are hash aggregates with map-side combine, so an entity in a
third of all rows is counted in parts. A second scan finds the occurrences: it lets
through what a table of ``SLOTS`` bits, of the hashes of all disclosing terms, does not
rule out, and a join on the term decides. So no task holds the terms, however many.

Defined cases: a null text counts as empty; null and repeated ids are kept row by
row (an internal row key ties a row to its contexts); an empty table gives an empty
result; extra columns are ignored. Entities enter the scratch table as hashes only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import map_batches, prepare, texts
from .bounded import saved
from .registry import register, table

KINDS = ("email", "ip", "card", "phone")
WINDOW = 8
MIN_SUPPORT = 3
GENERALISE_AT = 0.6
REMOVE_AT = 0.9
TERMS_HELD = 300_000
SLOTS = 1 << 22

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W\d_]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[Span]:
    """A match needs the '@' after its run of local characters, so each '@' is tried
    once with the whole run before it: linear where plain search is quadratic."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield "email", start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found: list[Span] = []
    if "@" in text:
        found += _emails(text)
    found += (("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and _luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += (("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                  if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15)
    return found


def outside_terms(matches: Iterable[re.Match], spans: list[Span]) -> list[tuple[int, int]]:
    """(start, end) of the terms that touch no entity."""
    covered: list[list[int]] = []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    starts = [s for s, _ in covered]
    terms = []
    for m in matches:
        i = bisect_left(starts, m.end()) - 1  # the last covered stretch that begins before the term's end
        if i < 0 or covered[i][1] <= m.start():
            terms.append((m.start(), m.end()))
    return terms


def contexts(text: str, spans: list[Span], window: int = WINDOW) -> list[tuple[int, str]]:
    """(entity hash, term) for every term near an entity, outside all entities."""
    terms = outside_terms(_TERM.finditer(text), spans)
    at = [s for s, _ in terms]
    out = []
    for kind, s, e in spans:
        value = text[s:e].lower() if kind in ("email", "ip") else _NOT_DIGIT.sub("", text[s:e])
        entity = xxhash.xxh3_64_intdigest(f"{kind}:{value}".encode()) - (1 << 63)
        i = bisect_left(at, s)
        out += ((entity, text[ts:te].lower()) for ts, te in terms[max(0, i - window): i + window])
    return out


def find_contexts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """entity, term: a row for every term in a context."""

    def scan(b: pa.RecordBatch) -> pa.RecordBatch | None:
        near = [x for t in texts(b) if (found := base_spans(t)) for x in contexts(t, found, window)]
        if not near:
            return None
        entities, terms = zip(*near)
        return pa.RecordBatch.from_arrays([pa.array(entities, pa.int64()), pa.array(terms, pa.string())], ["entity", "term"])

    return map_batches(docs.select("text"), scan, "entity bigint, term string")


class _Possible(dict):
    """Whether a word, as it is written, may be one of the terms whose slots are given."""

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = np.zeros(SLOTS, bool)
        self.slots[slots] = True

    def __missing__(self, word: str) -> bool:
        self[word] = possible = bool(self.slots[slot_of(word.lower())])
        return possible


def slot_of(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode()) % SLOTS


def slots_of(terms: DataFrame) -> np.ndarray:
    """The distinct slots of the terms, ``SLOTS`` at most."""

    def scan(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(map(slot_of, b.column("term").to_pylist()), pa.int32())], ["slot"])

    found = map_batches(terms.select("term"), scan, "slot int").distinct().toArrow()
    return found.column("slot").to_numpy()


def find_entities(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """doc_id, base (array of kind, start, end), terms (array of term, start, end: those outside
    entities whose slot is among ``slots``)."""
    span = pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())])
    place = pa.struct([("term", pa.string()), ("s", pa.int32()), ("e", pa.int32())])
    ready: list[_Possible] = []  # one per Python worker

    def scan(b: pa.RecordBatch) -> pa.RecordBatch:
        if not ready or len(ready[0]) > TERMS_HELD:
            ready[:] = [_Possible(slots)]
        possible = ready[0]
        base, terms = [], []
        for t in texts(b):
            found = base_spans(t)
            base.append([dict(zip(("kind", "s", "e"), x)) for x in found])
            matches = [m for m in _TERM.finditer(t) if possible[m.group()]] if len(slots) else []
            terms.append([{"term": t[s:e].lower(), "s": s, "e": e} for s, e in outside_terms(matches, found)])
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(terms, pa.list_(place))],
            ["doc_id", "base", "terms"])

    return map_batches(
        docs.select("doc_id", "text"), scan,
        f"doc_id {dict(docs.dtypes)['doc_id']}, base array<struct<kind:string,s:int,e:int>>, "
        "terms array<struct<term:string,s:int,e:int>>")


def term_counts(docs: DataFrame) -> DataFrame:
    """term, c: occurrences in all texts. A task hands on its counts whenever it holds many terms."""
    prepare(docs.sparkSession)

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["term", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for t in texts(b):
                held.update(map(str.lower, _TERM.findall(t)))
                if len(held) >= TERMS_HELD:
                    yield rows(held)
                    held.clear()
        if held:
            yield rows(held)

    return docs.select("text").mapInArrow(count, "term string, c bigint").groupBy("term").agg(F.sum("c").alias("c"))


def disclosing_pairs(near: DataFrame, counts: DataFrame, min_support: int = MIN_SUPPORT,
                     generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """entity, term, disclosure, action for every pair at or over ``generalise_at``."""
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("co"))
    mass = near.groupBy("entity").agg(F.count(F.lit(1)).alias("m"))
    total = counts.agg(F.sum("c").alias("n"))  # one row
    known = pairs.where(F.col("co") >= min_support).join(counts, "term").join(mass, "entity")
    n = F.col("n").cast("double")
    d = F.log2(F.col("co") * n / (F.col("m") * F.col("c"))) / F.log2(n / F.col("m"))
    return (known.crossJoin(F.broadcast(total)).where(F.col("m") < F.col("n"))
            .select("entity", "term", d.alias("disclosure"))
            .where(F.col("disclosure") >= generalise_at)
            .withColumn("action", F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise")))


def sanitisation_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``added`` (arrays of kind, s, e); added
    kinds are ``generalise`` and ``remove``."""
    near = saved(find_contexts(docs), "pii")
    pairs = disclosing_pairs(near, saved(term_counts(docs), "pii"))  # counted once, used twice
    # 'remove' sorts last
    terms = saved(pairs.groupBy("term").agg(F.max("action").alias("kind")), "pii")
    found = saved(find_entities(docs, slots_of(terms)).withColumn("row", F.monotonically_increasing_id()), "pii")
    hits = found.select("row", F.explode("terms").alias("x")).select("row", "x.*").join(terms, "term")
    added = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "s", "e"))).alias("added"))
    none = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    return found.drop("terms").join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("added", none).alias("added"))


def sanitised_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text with entities and disclosing terms masked. Needs unique, non-null ids, which
    tie texts and spans together."""
    marked = docs.select("doc_id", "text").join(sanitisation_spans(docs), "doc_id")

    def mask(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, base, added in zip(texts(b), b.column("base").to_pylist(), b.column("added").to_pylist()):
            parts, at = [], 0
            for x in sorted(base + added, key=lambda x: (x["s"], -x["e"])):
                if x["s"] >= at:
                    parts += [t[at:x["s"]], {"remove": "", "generalise": "[TERM]"}.get(x["kind"], f"[{x['kind'].upper()}]")]
                at = max(at, x["e"])
            out.append("".join(parts) + t[at:])
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return map_batches(marked, mask, f"doc_id {dict(docs.dtypes)['doc_id']}, text string")


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


@register("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = sanitisation_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans.select(
        "doc_id", *map(count, KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"))


def base_digest(text: str | None) -> str:
    """The digest of ``base_spans`` as the query returns it (for tests)."""
    return sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base_spans(text or "")).encode()).hexdigest()
