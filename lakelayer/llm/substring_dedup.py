"""Suffix-array deduplication: maximal repeats across documents, and their removal.

Texts are UTF-8 bytes. A byte goes when it is covered by a string of ``LENGTH`` (50) bytes
that also starts in a document with a smaller id; strings are judged on the input. Texts
that equal one of a smaller id go whole (by content hash; if they have 50 bytes at all).

No suffix array of the whole corpus is built. Windows of 50 bytes have an anchor
(``repeats``), and equal windows meet through equal anchors:

1. Batches send the distinct hashes of their anchors to parts by hash range (``mail``).
   Parts answer which of them occur in two documents.
2. Batches send the contexts of these anchors: up to 68 bytes with all windows of the
   anchor.
3. Each part joins its distinct contexts into an enhanced suffix array, scans the tree of
   common-prefix intervals and tests the byte before: the maximal repeat groups with all
   their occurrences. In each group, the document with the smallest id stays.
4. Batches take the answers and cut the texts.

A group of copies, a frequent line or passage is one context per part, whatever the number
of its documents, and its occurrences are a few numbers each. A repeat longer than a
context shows as groups that overlap.

Defined cases: a null text is empty; a text under 50 bytes keeps all; a null id is larger
than any other and equal to none; rows with the same id never remove from each other; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import texts
from .mail import batches_and_parts, cuts, dealt, from_planes, mixed, packed, planes, unpacked
from .registry import register, table
from .repeats import LENGTH, STEPS, WIDTH, ContextIndex, Runs, find_runs, repeated_windows

FINER = 2  # batches and parts for each shuffle partition; both hold their bytes several times over
LAST_ID = np.iinfo(np.int64).max  # stands for a null id
_COPIES = 0  # kinds of mail to a batch
_ANSWER = 1


def _in_order(group: pa.Table) -> pa.Table:
    """The rows of a batch in the order of their key, which every step finds again."""
    return group.sort_by("row")


def _ranks(group: pa.Table) -> np.ndarray:
    return group.column("doc_id").fill_null(LAST_ID).to_numpy().astype(np.int64)


def _own_texts(group: pa.Table, mail: pa.Table) -> list[bytes]:
    """The texts of an ordered batch; those that copy another text are empty."""
    copies = {r for rows, kind in zip(mail.column("rows").to_pylist(), mail.column("kind").to_pylist())
              if kind == _COPIES for r in rows}
    return [b"" if r in copies else t.encode() for t, r in zip(texts(group), group.column("row").to_pylist())]


def _asked(runs: Runs, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, which each run has, whether two documents of the batch have it)."""
    distinct, which = np.unique(runs.hashes, return_inverse=True)
    rank = ranks[runs.owner]
    low, high = np.full(len(distinct), LAST_ID), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, which, rank)
    np.maximum.at(high, which, rank)
    return distinct, which, low < high


def _ask(parts: int):
    def ask(key: tuple, group: pa.Table, mail: pa.Table) -> pa.Table:
        group = _in_order(group)
        distinct, _, twice = _asked(find_runs(_own_texts(group, mail)), _ranks(group))
        at = cuts(distinct, parts)
        return pa.table({"batch": pa.array([key[0].as_py()] * parts, pa.int32()), "part": pa.array(range(parts), pa.int32()),
                         "hashes": pa.array([planes(distinct[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
                         "twice": packed([np.packbits(twice[a:b]) for a, b in zip(at, at[1:])])})

    return ask


def _shared(key: tuple, group: pa.Table) -> pa.Table:
    asked = [from_planes(b, np.uint64) for b in group.column("hashes").to_pylist()]
    distinct, which, count = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
    shared = count > 1
    twice = [np.unpackbits(t, count=len(a)) for t, a in zip(unpacked(group, "twice", np.uint8), asked)]
    shared[which[np.concatenate(twice).astype(bool)]] = True
    answers = np.split(shared[which], np.cumsum([len(a) for a in asked])[:-1])
    return pa.table({"batch": group.column("batch"), "part": group.column("part"),
                     "body": packed([np.packbits(a) for a in answers])})


def _contexts(parts: int):
    def contexts(key: tuple, group: pa.Table, mail: pa.Table) -> pa.Table:
        group = _in_order(group)
        own, ranks = _own_texts(group, mail), _ranks(group)
        runs = find_runs(own)
        distinct, which, _ = _asked(runs, ranks)
        answers = mail.filter(pa.compute.equal(mail.column("kind"), _ANSWER)).sort_by("part")
        at = cuts(distinct, parts)
        bits = [np.zeros(0, np.uint8)] + [np.unpackbits(b, count=int(n)) for b, n in
                                          zip(unpacked(answers, "body", np.uint8), np.diff(at))]
        shared = np.concatenate(bits).astype(bool)
        if len(shared) != len(distinct):
            raise RuntimeError("the documents changed while they were being compared")
        runs = runs.take(np.flatnonzero(shared[which]))
        runs = runs.take(np.lexsort((runs.first, runs.owner, runs.hashes)))
        at = cuts(runs.hashes, parts)
        sizes = (runs.last - runs.first + LENGTH).astype(np.uint8)
        spans = list(zip(runs.owner.tolist(), runs.first.tolist(), (runs.last + LENGTH).tolist()))
        columns = {"batch": pa.array([key[0].as_py()] * parts, pa.int32()), "part": pa.array(range(parts), pa.int32())}
        ranges = list(zip(at, at[1:]))
        columns["owners"] = packed([runs.owner[a:b].astype(np.uint32) for a, b in ranges])
        columns["firsts"] = packed([runs.first[a:b].astype(np.uint32) for a, b in ranges])
        met = [np.unique(runs.owner[a:b]) for a, b in ranges]
        columns["met"] = packed([m.astype(np.uint32) for m in met])
        columns["ranks"] = packed([ranks[m] for m in met])
        columns["sizes"] = packed([sizes[a:b] for a, b in ranges])
        columns["bodies"] = pa.array([b"".join([own[o][s:e] for o, s, e in spans[a:b]]) for a, b in ranges], pa.binary())
        return pa.table(columns)

    return contexts


def _rows_of(bodies: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Joined bodies as rows of WIDTH bytes, zero-padded."""
    out = np.zeros((len(sizes), WIDTH), np.uint8)
    out[np.arange(WIDTH) < sizes[:, None]] = bodies
    return out


def _distinct_rows(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one index per distinct row, which of these each row equals), by hash and then by bytes."""
    padded = np.zeros((len(rows), -(-WIDTH // 8) * 8), np.uint8)
    padded[:, :WIDTH] = rows
    hashes = sizes.astype(np.uint64)
    for word in padded.view(np.uint64).T:
        hashes = mixed(hashes ^ word)
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = (sizes[order[1:]] != sizes[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


class _Part:
    """What all batches sent to a part: occurrences of contexts."""

    def __init__(self, group: pa.Table) -> None:
        self.sizes_of = unpacked(group, "sizes", np.uint8)
        self.owners, self.firsts = unpacked(group, "owners", np.uint32), unpacked(group, "firsts", np.uint32)
        ranks = [r[np.searchsorted(m, o)] for r, m, o in
                 zip(unpacked(group, "ranks", np.int64), unpacked(group, "met", np.uint32), self.owners)]
        self.rank = np.concatenate(ranks)
        sizes = np.concatenate(self.sizes_of).astype(np.int64)
        bodies = np.frombuffer(b"".join(group.column("bodies").to_pylist()), np.uint8)
        rows = _rows_of(bodies, sizes)
        chosen, self.which = _distinct_rows(rows, sizes)
        self.least = np.full(len(chosen), LAST_ID)
        np.minimum.at(self.least, self.which, self.rank)
        self.index = ContextIndex(rows[chosen], sizes[chosen])
        self.groups = self.index.maximal_repeats()


def _judge(key: tuple, group: pa.Table) -> pa.Table:
    part = _Part(group)
    of_context = repeated_windows(part.index, part.groups, part.least)
    every = ((np.uint64(1) << (part.index.sizes - LENGTH + 1).astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    bits = np.where(part.rank > part.least[part.which], every[part.which], of_context[part.which])
    ends = np.cumsum([len(o) for o in part.owners])[:-1]
    found = [np.flatnonzero(b) for b in np.split(bits, ends)]
    return pa.table({
        "batch": group.column("batch"),
        "owners": packed([o[f] for o, f in zip(part.owners, found)]),
        "firsts": packed([x[f] for x, f in zip(part.firsts, found)]),
        "windows": packed([b[f] for b, f in zip(np.split(bits, ends), found)])})


def _cut(key: tuple, group: pa.Table, mail: pa.Table) -> pa.Table:
    group = _in_order(group)
    raw = [t.encode() for t in texts(group)]
    own = _own_texts(group, mail)
    answers = mail.filter(pa.compute.equal(mail.column("kind"), _ANSWER))
    join = lambda name: np.concatenate([np.zeros(0, np.uint32), *unpacked(answers, name, np.uint32)])
    owner, first, windows = join("owners"), join("firsts"), join("windows")
    order = np.argsort(owner, kind="stable")
    owner, first, windows = owner[order], first[order].astype(np.int64), windows[order]
    at = np.searchsorted(owner, np.arange(len(raw) + 1))
    kept, spans = [], []
    for i, t in enumerate(raw):
        if len(t) >= LENGTH and not own[i]:  # a copy
            kept.append(b"")
            spans.append([(0, len(t))])
            continue
        a, b = at[i], at[i + 1]
        if a == b:
            kept.append(t)
            spans.append([])
            continue
        starts = first[a:b, None] + np.arange(STEPS)
        starts = starts[(windows[a:b, None] >> np.arange(STEPS, dtype=np.uint32)) & 1 == 1]
        change = np.zeros(len(t) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
        gone = np.cumsum(change[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes())
        spans.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    return pa.table({"doc_id": group.column("doc_id"), "n_bytes": pa.array([len(t) for t in raw], pa.int64()),
                     "spans": pa.array([[dict(zip(("start", "stop"), x)) for x in s] for s in spans], pa.list_(span)),
                     "kept": pa.array(kept, pa.binary())})


def _steps(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents in batches, copies per batch, contexts per part)."""
    parts = FINER * batches_and_parts(docs.sparkSession)  # of batches as well
    typed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = dealt(typed, parts, F.xxhash64("doc_id", "text").alias("row"))
    keyed = rows.select("batch", "row", F.coalesce("doc_id", F.lit(LAST_ID)).alias("rank"),
                        F.md5(F.coalesce("text", F.lit(""))).alias("content"))
    least = keyed.groupBy("content").agg(F.min("rank").alias("least"))
    copies = (keyed.join(least, "content").where("rank > least").groupBy("batch")
              .agg(F.collect_set("row").alias("rows")))  # of one batch at most
    copies = copies.select(F.col("batch").alias("batch"), F.lit(_COPIES).alias("kind"), F.lit(-1).alias("part"), "rows")
    empty = lambda mail, body: mail.select(
        "batch", F.lit(_ANSWER).alias("kind"), "part", F.lit(None).cast("array<bigint>").alias("rows"), body)
    asked = rows.groupBy("batch").cogroup(copies.groupBy("batch")).applyInArrow(
        _ask(parts), "batch int, part int, hashes binary, twice binary")
    shared = asked.groupBy("part").applyInArrow(_shared, "batch int, part int, body binary")
    mail = copies.withColumn("body", F.lit(None).cast("binary")).unionByName(empty(shared, "body"))
    contexts = rows.groupBy("batch").cogroup(mail.groupBy("batch")).applyInArrow(
        _contexts(parts), "batch int, part int, owners binary, firsts binary, met binary, ranks binary, sizes binary, "
                          "bodies binary")
    return rows, copies, contexts


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, stop: the maximal removed runs), kept (bytes)."""
    rows, copies, contexts = _steps(docs)
    judged = contexts.groupBy("part").applyInArrow(
        _judge, "batch int, owners binary, firsts binary, windows binary")
    names = ("owners", "firsts", "windows")
    mail = copies.select("batch", "kind", "rows", *(F.lit(None).cast("binary").alias(n) for n in names)).unionByName(
        judged.select("batch", F.lit(_ANSWER).alias("kind"), F.lit(None).cast("array<bigint>").alias("rows"), *names))
    return rows.groupBy("batch").cogroup(mail.groupBy("batch")).applyInArrow(
        _cut, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def repeat_groups(docs: DataFrame) -> DataFrame:
    """The maximal repeat groups with all occurrences: part and number of the group, length, doc_id,
    start (byte position). Copies of whole texts take part through the one of smallest id."""
    _, _, contexts = _steps(docs)

    def listed(key: tuple, group: pa.Table) -> pa.Table:
        part = _Part(group)
        g = part.groups
        which = np.repeat(np.arange(len(g.start)), g.size)
        at = g.start[which] + np.arange(len(which)) - np.repeat(np.cumsum(g.size) - g.size, g.size)
        context, offset = np.divmod(g.members[at], STEPS)
        # every occurrence of the context
        by_context = np.argsort(part.which, kind="stable")
        begin = np.searchsorted(part.which[by_context], np.arange(len(part.least) + 1))
        count = (begin[1:] - begin[:-1])[context]
        row = np.repeat(np.arange(len(which)), count)
        one = by_context[begin[context][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)]
        first = np.concatenate(part.firsts).astype(np.int64)
        rank = part.rank[one]
        return pa.table({"part": pa.array([key[0].as_py()] * len(row), pa.int32()), "number": which[row],
                         "length": g.length[which[row]], "doc_id": pa.array(rank, mask=rank == LAST_ID),
                         "start": first[one] + offset[row]})

    return contexts.groupBy("part").applyInArrow(
        listed, "part int, number bigint, length bigint, doc_id bigint, start bigint")


@register("op7_suffix_array_dedup")
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
