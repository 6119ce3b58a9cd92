r"""Exact n-gram Jaccard self-join of documents and its components, by PartEnum signatures.

Two documents link when their shingle sets reach Jaccard similarity 4/5 exactly
(``shingles``, ``partenum``). Steps:

1. Batches sign their distinct sets and send each signature to a part by hash range. Parts
   keep the signatures that at least two different sets share (``entries``).
2. A set is dropped when it has fewer shared signatures than a similar set would surely
   share with it, again until little changes.
3. In a large bucket (over ``LARGE`` sets) an entry is dropped when its set can be found
   without it (``need``). What is left there are the sets of large near-copy groups.
4. Candidates are verified on the whole sets. First each set with the leader it shares most
   signatures with, a leader being the set of a bucket that shares most in all; then, in
   buckets whose sets are not yet in one component, each set with the leader. Most of a
   group of near copies is one component by then, at one comparison per member.
5. What is still apart is compared in full: in small buckets pair by pair, in large ones
   every set outside the main component against the whole cluster, block by block, which
   emits the links only. So no link is lost.

Between steps small tables are written to the shared scratch folder. Documents with equal
sets share one id, so copies take no part in the join.

Defined cases: a null text counts as empty; empty sets link with nothing (the component is
the document itself); null ids are kept, and a component of such rows alone has a null id;
repeated rows are kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrow import map_batches, texts
from .bounded import counted, filtered, saved
from .components import components
from .mail import batches_and_parts, cuts, packed, unpacked
from .partenum import Bands, sign
from .registry import register, table
from .shingles import ShingleSets, set_ids

LARGE = 16
BLOCK = 1024  # sets on either side of a block of a large cluster
SIGNED_AT_ONCE = 4 << 20  # characters; their sets are held several times over
PRUNE_ROUNDS = 2
LEADER_ROUNDS = 1

_MESSAGE = ("part int, signatures binary, owners binary, sids binary, needs binary, "
            "doc_ids array<bigint>, rows array<bigint>, sizes array<bigint>, doc_sids array<bigint>")
_FOUND = "signature bigint, sid bigint, need int, doc_id bigint, row bigint, size bigint"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _messages(sets: ShingleSets, batch: list[str], ids: list, rows: list, parts: int) -> pa.RecordBatch:
    """One row per part: its signatures of this batch, and a share of the batch's documents."""
    elements, sizes = sets.sets(batch)
    sids = set_ids(elements, sizes)
    starts = np.cumsum(sizes) - sizes
    _, first = np.unique(sids, return_index=True)
    first = first[sizes[first] > 0]
    signatures, owners, needs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(first):
        for band, index in Bands(int(sizes.max())).signing(sizes[first]):
            own = first[index]
            lengths = sizes[own]
            at = np.repeat(starts[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            s, o, need = sign(band, elements[at], lengths)
            signatures.append(s)
            owners.append(own[o])
            needs.append(need[o])
    signature, owner, need = map(np.concatenate, (signatures, owners, needs))
    order = np.argsort(signature, kind="stable")
    signature, owner, need = signature[order], owner[order], need[order]
    at = cuts(signature, parts)
    out = []
    for p, (a, b) in enumerate(zip(at, at[1:])):
        met, local = np.unique(owner[a:b], return_inverse=True)
        mine = range(p, len(batch), parts)
        out.append((p, signature[a:b].tobytes(), local.astype(np.uint32).tobytes(), sids[met].tobytes(),
                    need[a:b].astype(np.int32).tobytes(), [ids[i] for i in mine], [rows[i] for i in mine],
                    [int(sizes[i]) for i in mine], sids[p::parts].view(np.int64).tolist()))
    types = [pa.int32(), *[pa.binary()] * 4, *[pa.list_(pa.int64())] * 4]
    names = [x.split()[0] for x in _MESSAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _shared(key: tuple, group: pa.Table) -> pa.Table:
    """The entries of signatures that two or more sets share; the documents as they came."""
    owners, sids = unpacked(group, "owners", np.uint32), unpacked(group, "sids", np.uint64)
    signature = np.concatenate(unpacked(group, "signatures", np.uint64))
    need = np.concatenate(unpacked(group, "needs", np.int32))
    sid = np.concatenate([s[o] for s, o in zip(sids, owners)])
    order = np.lexsort((sid, signature))
    signature, sid, need = signature[order], sid[order], need[order]
    new = np.ones(len(signature), bool)
    new[1:] = (signature[1:] != signature[:-1]) | (sid[1:] != sid[:-1])
    signature, sid, need = signature[new], sid[new], need[new]
    _, which, count = np.unique(signature, return_inverse=True, return_counts=True)
    keep = count[which] > 1
    found, docs = int(keep.sum()), [group.column(c).combine_chunks().flatten() for c in ("doc_ids", "rows", "sizes", "doc_sids")]
    blank = lambda n, t=pa.int64(): pa.nulls(n, t)
    entries = pa.table({"signature": _signed(signature[keep]), "sid": _signed(sid[keep]), "need": pa.array(need[keep]),
                        "doc_id": blank(found), "row": blank(found), "size": blank(found)})
    n = len(docs[0])
    documents = pa.table({"signature": blank(n), "sid": docs[3], "need": blank(n, pa.int32()),
                          "doc_id": docs[0], "row": docs[1], "size": docs[2]})
    return pa.concat_tables([entries, documents])


def _row_key() -> F.Column:
    return F.xxhash64("doc_id", "text").alias("row")


def signature_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, row, size, sid; entries: signature, sid, need)."""
    spark = docs.sparkSession
    parts = batches_and_parts(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, ids, rows, size = ShingleSets(), [], [], [], 0
        for b in batches:
            for t, i, r in zip(texts(b), b.column("doc_id").to_pylist(), b.column("row").to_pylist()):
                held.append(t)
                ids.append(i)
                rows.append(r)
                size += len(t)
                if size >= SIGNED_AT_ONCE:
                    yield _messages(sets, held, ids, rows, parts)
                    held, ids, rows, size = [], [], [], 0
        if held:
            yield _messages(sets, held, ids, rows, parts)

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _row_key())
    path = scratch_path(spark, "signatures")
    (keyed.mapInArrow(run, _MESSAGE).groupBy("part").applyInArrow(_shared, _FOUND)
     .write.parquet(path))
    found = spark.read.schema(_FOUND).parquet(path)
    return (found.where("signature is null").select("doc_id", "row", "size", "sid"),
            found.where("signature is not null").select("signature", "sid", "need"))


def _in_shared_buckets(entries: DataFrame) -> DataFrame:
    sizes = entries.groupBy("signature").agg(F.count(F.lit(1)).alias("bucket"))
    return entries.join(sizes.where("bucket > 1"), "signature")


def pruned(entries: DataFrame) -> DataFrame:
    """signature, sid, bucket: entries of sets that can have a similar one, and that are
    needed to find it."""
    band = F.expr("signature & 255").alias("band")
    own = Window.partitionBy("sid", "band")
    for _ in range(PRUNE_ROUNDS):
        counted = entries.select("signature", "sid", "need", band).withColumn("n", F.count(F.lit(1)).over(own))
        entries = _in_shared_buckets(counted.where("n >= need").select("signature", "sid", "need"))
    # the sets of a large bucket that other signatures are sure to find leave it
    large = F.count(F.when(F.col("bucket") > LARGE, 1)).over(own)
    kept = entries.withColumn("band", band).withColumn("large", large).where(
        f"bucket <= {LARGE} or large >= need").select("signature", "sid")
    return saved(_in_shared_buckets(kept), "entries")


def whole_sets(docs: DataFrame, documents: DataFrame, entries: DataFrame) -> DataFrame:
    """sid, size, elements: the set of every id in ``entries``, from one document that has it."""
    wanted = (documents.groupBy("sid").agg(F.min("row").alias("row"))
              .join(entries.select("sid").distinct(), "sid", "left_semi").select("row"))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select(_row_key(), "text")
    rows = keyed.join(counted(wanted), "row", "left_semi")
    sets = ShingleSets()

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        elements, sizes = sets.sets(texts(b))
        ends = np.cumsum(sizes)
        return pa.RecordBatch.from_arrays(
            [_signed(set_ids(elements, sizes)), pa.array(sizes, pa.int64()), packed(np.split(elements, ends[:-1])),
             b.column("row")], ["sid", "size", "elements", "row"])

    found = map_batches(rows, run, "sid bigint, size bigint, elements binary, row bigint")
    # identical rows (same id and text) give the same set again
    one = Window.partitionBy("row").orderBy("sid")
    return saved(found.withColumn("n", F.row_number().over(one)).where("n = 1").select("sid", "size", "elements"), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets reach the similarity."""
    ids = pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid"))).distinct()
    sets = saved(sets.join(counted(ids), "sid", "left_semi"), "sets")
    a = sets.select(F.col("sid").alias("u"), F.col("size").alias("u_size"), F.col("elements").alias("u_set"))
    b = sets.select(F.col("sid").alias("v"), F.col("size").alias("v_size"), F.col("elements").alias("v_set"))
    sized = pairs.join(a.select("u", "u_size"), "u").join(b.select("v", "v_size"), "v").where(
        (5 * F.col("u_size") >= 4 * F.col("v_size")) & (5 * F.col("v_size") >= 4 * F.col("u_size"))).select("u", "v")
    both = sized.join(b.select("v", "v_set"), "v").join(a.select("u", "u_set"), "u")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(unpacked(batch, "u_set", np.uint64), unpacked(batch, "v_set", np.uint64)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= 80 * (len(x) + len(y) - common))
        return batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("u", "v", "u_set", "v_set"), run, "u bigint, v bigint")


def _apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """signature, sid, weight, label and bucket: the entries in buckets that still hold more than one component."""
    named = entries.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(
        "signature", "sid", "weight", F.coalesce("label", "sid").alias("label"))
    mixed = named.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                           F.count(F.lit(1)).alias("bucket"))
    return named.join(mixed.where("low < high").select("signature", "bucket"), "signature")


def _pair(u: str, v: str) -> list[F.Column]:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def _block_links(key: tuple, group: pa.Table) -> pa.Table:
    """Links between the sets of side 0 and of side 1 that have another label, one per set and label."""
    side = group.column("side").to_numpy()
    sids, labels = group.column("sid").to_numpy(), group.column("label").to_numpy()
    sets = unpacked(group, "elements", np.uint64)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    sizes = np.array([len(sets[i]) for i in right], np.int64)
    elements = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in right)])
    owner = np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    out: list[tuple[int, int]] = []
    for i in left:
        lo, hi = np.searchsorted(elements, sets[i], "left"), np.searchsorted(elements, sets[i], "right")
        n = hi - lo
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(owner[at], minlength=len(right))
        near = (100 * common >= 80 * (len(sets[i]) + sizes - common)) & (labels[right] != labels[i])
        met = right[np.flatnonzero(near)]
        _, first = np.unique(labels[met], return_index=True)
        out += [(int(sids[i]), int(sids[j])) for j in met[first]]
    return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([y for _, y in out], pa.int64())})


def _links_in_large_buckets(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between components that share a large bucket: every set outside the largest component
    of its cluster against every set of the cluster, in blocks of both. Only links leave a block.

    A cluster is what large buckets hold together. The blocks of a cluster are dealt over tasks,
    so none grows with it.
    """
    large = apart.where(F.col("bucket") > LARGE)
    ties = large.groupBy("signature").agg(F.min("sid").alias("u")).join(large, "signature").select("u", F.col("sid").alias("v"))
    cluster = components(saved(ties.where("u != v").distinct(), "edges")).withColumnRenamed("node", "sid")
    members = large.select("sid", F.col("label").alias("own")).distinct().join(cluster, "sid", "left").select(
        "sid", F.col("own").alias("label"), F.coalesce("label", "sid").alias("cluster"))
    members = saved(members, "members")
    counts = members.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("x"), F.sum("n").alias("m")).select(
        "cluster", F.col("x.label").alias("main"), F.ceil(F.col("m") / BLOCK).alias("blocks"),
        F.greatest(F.ceil((F.col("m") - F.col("x.n")) / BLOCK), F.lit(1)).alias("rest_blocks"))
    whole = members.join(main, "cluster").join(sets.select("sid", "elements"), "sid")
    part = lambda n, salt: F.pmod(F.xxhash64("sid", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rest = whole.where("label != main").select(
        "cluster", "sid", "label", "elements", F.lit(0).alias("side"), part("rest_blocks", 0).alias("i"), every("blocks").alias("j"))
    all_ = whole.select(
        "cluster", "sid", "label", "elements", F.lit(1).alias("side"), every("rest_blocks").alias("i"), part("blocks", 1).alias("j"))
    return rest.unionByName(all_).groupBy("cluster", "i", "j").applyInArrow(_block_links, "u bigint, v bigint")


def links(docs: DataFrame, documents: DataFrame, entries: DataFrame) -> DataFrame:
    """node, label: the components of the set ids that have a similar set."""
    sets = whole_sets(docs, documents, entries)
    # a set that shares most lies in the middle of its group and links to most of it
    weight = entries.groupBy("sid").agg(F.sum("bucket").alias("weight"))
    entries = saved(entries.select("signature", "sid").join(weight, "sid"), "entries")
    leaders = entries.groupBy("signature").agg(F.max(F.struct("weight", "sid"))["sid"].alias("leader"))
    met = entries.join(leaders, "signature").where("sid != leader").groupBy("sid", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = met.groupBy("sid").agg(F.max(F.struct("n", "leader"))["leader"].alias("leader"))
    tried = saved(best.select(*_pair("sid", "leader")).distinct(), "pairs")
    labels = components(saved(verified(tried, sets), "edges"))
    apart = entries
    for turn in range(LEADER_ROUNDS + 1):
        apart = saved(_apart(apart.select("signature", "sid", "weight"), labels), "apart")  # components only grow
        if apart.isEmpty():
            return labels
        if turn < LEADER_ROUNDS:
            top = apart.groupBy("signature").agg(F.max(F.struct("weight", "sid", "label")).alias("x"))
            other = top.select("signature", F.col("x.sid").alias("other"), F.col("x.label").alias("other_label"))
            met = apart.join(other, "signature").where("label != other_label")
            found = None
        else:
            small = apart.where(F.col("bucket") <= LARGE)
            other = small.select("signature", F.col("sid").alias("other"), F.col("label").alias("other_label"))
            met = small.join(other, "signature").where("label < other_label")
            found = _links_in_large_buckets(apart, sets)
        fresh = saved(met.select(*_pair("sid", "other")).distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
        new = verified(fresh, sets)
        new = saved(new if found is None else new.unionByName(found), "edges")
        tried = tried.unionByName(fresh)
        if not new.isEmpty():
            labels = components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(new))
    return labels


def _grouped(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with ``row``, the hash that tells rows of one id apart."""
    documents, entries = signature_tables(docs)
    labels = links(docs, documents, pruned(entries))
    # a set without shingles (sid 0) has no component of its own
    named = documents.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(
        "doc_id", "row", "size", F.when(F.col("size") > 0, F.coalesce("label", "sid")).alias("label"))
    least = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(least, "label", "left").select(
        "doc_id", "row", F.col("size").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) for every document."""
    return _grouped(docs).drop("row")


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that have a component mate of smaller id; all columns stay. Rows that
    share an id are judged each by its own text."""
    gone = _grouped(docs).where("doc_id != component_id").select("doc_id", "row").distinct()
    return filtered(docs, counted(gone), [F.col("doc_id"), _row_key()], "left_anti")


@register("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
