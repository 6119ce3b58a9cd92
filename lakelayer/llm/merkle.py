r"""Merkle manifest of a table of documents, with a proof for each row by pointer jumping.

``H`` is the lowercase hex SHA-256 of its inputs put together, digests as hex text. A row is a
leaf: H of its columns, each ``-`` if null, else byte count, ``:`` and value. Per language the
leaves ascend by id; while more than one node remains, every 8 consecutive ones (the last run
fewer, even one) become their H. What remains is the language's subroot, and the subroots,
null first, then bytewise by language, give the root in the same way.

* Positions. Rows are range-partitioned by (language, id, leaf) and sorted inside the
  partitions; a row's position is its place in the partition plus the sizes of the partitions
  before (one row a partition). No language meets in one task.
* Runs. A run is up to 8 consecutive siblings; grouping by (tree, position / 8) builds a level
  from the one below, an eighth of its size. Trees are the languages by number, and ``TOP``.
* Pointer jumping. Every run holds a pointer to the run of its parent and a segment: the
  siblings left and right of its parent there. A self-join of the runs replaces a pointer by
  the pointer's pointer and appends the pointed-to run's segment, so the distance doubles with
  each of the log2(height) joins until every run points beyond the root. Only leaves' runs
  carry rows; they are unfolded last, a leaf adding its own siblings to its run's segments.
  Runs pointed to over a great distance are few; they are broadcast when counted so (each has
  at most ``BROADCAST_RUNS`` rows of a few segments), else each is pointed to by a small part of
  the runs, and the join is a shuffle.

Tampering (of ids whose CRC is divisible by 3, in the query) lower-cases A-Z; the root folded
from the tampered leaf and the original siblings then differs from the root.

Defined cases: nulls in any column count as ``-``; rows of a null id come first and are never
tampered with; rows of equal id are ordered by leaf, equal rows are interchangeable; a null
text stays null; one row or one language gives a tree of one leaf (a proof of no siblings has
the H of nothing); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bounded import BROADCAST_ROWS, saved
from .registry import register, table

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the tree over the subroots
BROADCAST_RUNS = 10_000
_SEGMENTS = "array<struct<l:string,r:string>>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(encoded(columns[c]) for c in COLUMNS)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``: their place (0, 1, ...) by ``order``, nulls first. Written once."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())  # deals equal rows over partitions
    keys = [*(F.col(c).asc_nulls_first() for c in order), F.col("_tie").asc()]
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # the id of a sorted row: partition in the upper bits, place in the partition in the lower 33
    placed = saved(placed.withColumn("_id", F.monotonically_increasing_id()), name).select(
        "*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")).drop("_id")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # a row a partition
    return placed.join(F.broadcast(starts), "_part").withColumn("pos", F.col("_start") + F.col("_place")).drop(
        "_part", "_place", "_start")


def _few(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (written already), to be broadcast if there are at most ``limit``."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def _runs_up(nodes: DataFrame, name: str) -> tuple[DataFrame | None, DataFrame]:
    """All runs over the level-0 ``nodes`` (tree, pos, cnt, hash) up to one node a tree, and those last nodes.

    Runs: tree, level, run, cnt (nodes of the level in the tree), hashes. Last: tree, level (of the
    last run; -1 if the tree has one node from the start), hash.
    """
    runs, last, level = None, [], 0
    current = nodes.select("tree", "pos", "cnt", "hash")
    while True:
        last.append(current.where("cnt = 1").select("tree", F.lit(level - 1).alias("level"), "hash"))
        many = current.where("cnt > 1")
        grouped = many.groupBy("tree", F.floor(F.col("pos") / FAN).alias("run"), "cnt").agg(
            F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col("hash")))).alias("m"))
        made = saved(grouped.select("tree", F.lit(level).alias("level"), "run", "cnt", F.col("m.hash").alias("hashes")), name)
        most = made.agg(F.max("cnt")).first()[0]
        if most is None:
            break
        runs = made if runs is None else runs.unionByName(made)
        current = made.select("tree", F.col("run").alias("pos"), F.ceil(F.col("cnt") / FAN).alias("cnt"),
                              F.sha2(F.concat_ws("", "hashes"), 256).alias("hash"))
        level += 1
    top = last[0]
    for t in last[1:]:
        top = top.unionByName(t)
    return runs, top


def _beside(hashes: Column, at: Column) -> Column:
    """The siblings of place ``at`` (0-based): (left, right), each put together."""
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("l"),
                    F.array_join(F.slice(hashes, at + 2, F.lit(FAN)), "").alias("r"))


def _children(runs: DataFrame) -> DataFrame:
    """For every place of a run: tree, level, run, at (0-based) and the siblings beside it."""
    return runs.select("tree", "level", "run", F.posexplode("hashes").alias("at", "_h"), "hashes").select(
        "tree", "level", "run", "at", _beside(F.col("hashes"), F.col("at")).alias("beside"))


def jump(runs: DataFrame, height: int) -> DataFrame:
    """``runs`` (id, up, path; ``up`` null beyond the root) with every path completed to the root.

    Each join doubles the distance of ``up``; a run at distance d is pointed to only from d levels
    below, so those joined to become fewer with each doubling.
    """
    distance = 1
    while distance < height:
        pointed = saved(runs.where("level >= %d" % distance).select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path")), "merkle-pointed")
        joined = runs.join(_few(pointed, BROADCAST_RUNS), "up", "left")
        runs = saved(joined.select(
            "id", "level", F.col("_up").alias("up"),
            F.concat("path", F.coalesce("_path", F.array().cast(_SEGMENTS))).alias("path")), "merkle-paths")
        distance *= 2
    return runs


def _pointers(runs: DataFrame | None, tops: DataFrame | None, langs: DataFrame) -> tuple[DataFrame, int]:
    """Every run with its pointer and segment: (id, level, up, path), and the height of the whole tree.

    A run is known by (tree, level, run). A tree's last run (level 0 also where the tree has one
    leaf) points to the run of its subroot in ``TOP``; levels count on over both.
    """
    run_id = lambda tree, level, run: F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"),
                                               run.cast("long").alias("run"))
    rows = langs.select("tree", "cnt", F.greatest(F.col("level"), F.lit(0)).alias("last"))
    below = rows.agg(F.max("last")).first()[0]  # the level of the highest last run
    parts = []
    if runs is not None:  # the children of a run above level 0 are runs themselves
        parts.append(_children(runs.where("level > 0")).select(
            run_id(F.col("tree"), F.col("level") - 1, F.col("run") * FAN + F.col("at")).alias("id"), (F.col("level") - 1).alias("level"),
            run_id(F.col("tree"), F.col("level"), F.col("run")).alias("up"), F.array("beside").alias("path")))
    height = below + 1
    if tops is None:
        parts.append(rows.select(run_id(F.col("tree"), F.col("last"), F.lit(0)).alias("id"), F.col("last").alias("level"),
                                 F.lit(None).alias("up"), F.array().alias("path")))
    else:
        spots = _children(tops)
        least = spots.where("level = 0").select((F.col("run") * FAN + F.col("at")).alias("tree"), "run", "beside")
        parts.append(rows.join(least, "tree").select(
            run_id(F.col("tree"), F.col("last"), F.lit(0)).alias("id"), F.col("last").alias("level"),
            run_id(F.lit(TOP), F.lit(0), F.col("run")).alias("up"), F.array("beside").alias("path")))
        parts.append(spots.where("level > 0").select(
            run_id(F.lit(TOP), F.col("level") - 1, F.col("run") * FAN + F.col("at")).alias("id"), (F.col("level") + below).alias("level"),
            run_id(F.lit(TOP), F.col("level"), F.col("run")).alias("up"), F.array("beside").alias("path")))
        highest = tops.agg(F.max("level")).first()[0]
        height += highest + 1
        parts.append(tops.where(F.col("level") == highest).select(
            run_id(F.lit(TOP), F.col("level"), F.col("run")).alias("id"), (F.col("level") + 1 + below).alias("level"),
            F.lit(None).alias("up"), F.array().alias("path")))
    kind = "struct<tree:bigint,level:int,run:bigint>"
    out = None
    for p in parts:
        p = p.select(F.col("id").cast(kind).alias("id"), F.col("level").cast("int").alias("level"), F.col("up").cast(kind).alias("up"),
                     F.col("path").cast(_SEGMENTS).alias("path"))
        out = p if out is None else out.unionByName(p)
    return out, height


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, path (siblings left and right, level by
    level up to the root), folded_root, verified.

    ``tampered`` (a condition on the documents) marks those whose text is tampered with before the fold.
    """
    own = {c: F.col(c) for c in COLUMNS}
    changed = F.lit(None).cast("string") if tampered is None else F.when(
        tampered, leaf_hash(own | {"text": lower_ascii(F.col("text"))}))
    leaves = saved(docs.select("doc_id", "lang", leaf_hash(own).alias("leaf"), changed.alias("changed")), "merkle-leaves")
    placed = numbered(leaves, ["lang", "doc_id", "leaf"], "merkle-placed")
    sizes = saved(placed.groupBy("lang").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("cnt")), "merkle-langs")
    langs = saved(numbered(sizes, ["start"], "merkle-trees").withColumnRenamed("pos", "tree"), "merkle-langs")
    lang = langs.select(F.col("lang").alias("_lang"), "start", "cnt", "tree")
    nodes = placed.join(_few(lang, BROADCAST_ROWS), F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "tree", (F.col("pos") - F.col("start")).alias("pos"), "cnt", F.col("leaf").alias("hash"), "doc_id", "changed")
    nodes = saved(nodes, "merkle-nodes")

    runs, subroots = _runs_up(nodes, "merkle-runs")
    subroots = saved(subroots, "merkle-subroots")
    n = subroots.count()
    if n == 0:
        return leaves.select("doc_id", "leaf", *(F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256")),
                             F.lit(None).cast(_SEGMENTS).alias("path"), F.lit(None).cast("string").alias("folded_root"),
                             F.lit(None).cast("boolean").alias("verified"))
    tops, root = _runs_up(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("pos"), F.lit(n).alias("cnt"), "hash"),
                          "merkle-tops")
    root = saved(root.select(F.col("hash").alias("root")), "merkle-root")  # one row
    trees = saved(langs.select("tree", "cnt").join(subroots.select("tree", "level", F.col("hash").alias("subroot")), "tree"),
                  "merkle-subroots")
    pointers, height = _pointers(runs, tops, trees)
    paths = jump(saved(pointers, "merkle-pointers"), height)

    # the leaves' runs with their rows, a run of at most 8
    run = F.floor(F.col("pos") / FAN)
    bottom = nodes.groupBy("tree", run.alias("run")).agg(F.array_sort(F.collect_list(
        F.struct("pos", F.col("hash").alias("leaf"), "doc_id", "changed"))).alias("rows"))
    whole = paths.where("level = 0 and id.tree >= 0").select(F.col("id.tree").alias("_tree"), F.col("id.run").alias("_run"), F.col("path").alias("above"))
    found = bottom.join(whole, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_run")))
    found = found.join(_few(trees.select(F.col("tree").alias("_t"), "cnt", "subroot"), BROADCAST_ROWS), F.col("tree") == F.col("_t"))
    each = found.select("cnt", "subroot", "above", F.col("rows.leaf").alias("hashes"), F.posexplode("rows").alias("at", "row"))
    path = F.when(F.col("cnt") > 1, F.concat(F.array(_beside(F.col("hashes"), F.col("at"))), "above")).otherwise(F.col("above"))
    proved = each.select(F.col("row.doc_id").alias("doc_id"), F.col("row.leaf").alias("leaf"),
                         F.coalesce("row.changed", "row.leaf").alias("claimed"), "subroot", path.alias("path"))
    folded = F.aggregate("path", F.col("claimed"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    return proved.crossJoin(F.broadcast(root)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "path", folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE base AS (
  SELECT doc_id, lang, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 3 = 0 THEN sha256(head || coalesce(octet_length(encode(text)) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed FROM base),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS cnt, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves),
up AS (
  SELECT tree, 0 AS level, pos, cnt, leaf AS hash FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, (cnt + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM up WHERE cnt > 1
  GROUP BY tree, level, pos // 8, cnt),
subroots AS (SELECT tree, level, hash, count(*) OVER () AS trees FROM up WHERE cnt = 1),
top AS (
  SELECT 0 AS level, tree AS pos, trees AS cnt, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (cnt + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM top WHERE cnt > 1
  GROUP BY level, pos // 8, cnt),
nodes AS (
  SELECT u.tree, u.level, u.pos, u.cnt, u.hash FROM up u
  UNION ALL SELECT -1, level, pos, cnt, hash FROM top),
beside AS (
  SELECT tree, level, pos, cnt,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, pos // 8 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, pos // 8 ORDER BY pos
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes),
walk AS (
  SELECT row_number() OVER () AS id, doc_id, leaf, tree AS own, tree, 0 AS level, pos, cnt,
    coalesce(changed, leaf) AS hash, '' AS proof FROM placed
  UNION ALL
  SELECT w.id, w.doc_id, w.leaf, w.own, CASE WHEN w.cnt > 1 THEN w.tree ELSE -1 END,
    CASE WHEN w.cnt > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.cnt > 1 THEN w.pos // 8 ELSE w.tree END,
    CASE WHEN w.cnt > 1 THEN (w.cnt + 7) // 8 ELSE (SELECT count(*) FROM subroots) END,
    CASE WHEN w.cnt > 1 THEN sha256(b.l || w.hash || b.r) ELSE w.hash END,
    CASE WHEN w.cnt > 1 THEN w.proof || b.l || b.r ELSE w.proof END
  FROM walk w JOIN beside b ON b.tree = w.tree AND b.level = w.level AND b.pos = w.pos
  WHERE w.cnt > 1 OR w.tree >= 0),
rooted AS (SELECT hash AS root FROM top WHERE cnt = 1)
SELECT w.doc_id, w.leaf, s.hash AS subroot, t.root, sha256(w.proof) AS proof_sha256, w.hash AS folded_root, w.hash = t.root AS verified
FROM walk w JOIN subroots s ON s.tree = w.own CROSS JOIN rooted t WHERE w.tree = -1 AND w.cnt = 1"""


@register("op12_merkle_manifest", ORACLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return manifest(table(spark, sf_dir, "documents"), third).drop("path")
