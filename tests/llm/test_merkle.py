"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakelayer.llm import merkle


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(nodes):
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, k in enumerate(at):
            start = k // 8 * 8
            paths[i].append(("".join(nodes[start:k]), "".join(nodes[k + 1: start + 8])))
            at[i] = k // 8
        nodes = [_h("".join(nodes[i: i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    """rows of (doc_id, text, lang, source, n_chars)."""
    def leaf(d, t, lang, s, n):
        return _h("".join(map(_field, (d, s, lang, n, t))))

    langs = {}
    for d, t, lang, s, n in rows:
        low = None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        hit = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        langs.setdefault(lang, []).append((d, leaf(d, t, lang, s, n), leaf(d, low, lang, s, n) if hit else None))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for x in names:
        langs[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [_tree([r[1] for r in langs[x]]) for x in names]
    root, above = _tree([t[0] for t in trees])
    out = []
    for x, (subroot, paths), top in zip(names, trees, above):
        for (d, leaf_, changed), path in zip(langs[x], paths):
            h = changed or leaf_
            for left, right in path + top:
                h = _h(left + h + right)
            out.append((d, leaf_, subroot, root, _h("".join(a + b for a, b in path + top)), h, h == root))
    return sorted(out, key=str)


_R = random.Random(1)
CASES = {
    "mixed": [(i, _R.choice(["AbC", "xyz", None, "", "É x"]), _R.choice(["en", "de", None, "fr", ""]), _R.choice(["s", None]),
               _R.choice([3, None])) for i in _R.sample(range(10_000), 200)],
    "one row": [(5, "A", "en", "s", 1)],
    "one language": [(i, f"A{i}", "en", "s", 1) for i in range(65)],
    "many languages": [(i, f"A{i}", f"l{i}", "s", 1) for i in range(70)] + [(i, "B", "l3", "s", 1) for i in range(100, 180)],
    "repeated and null rows": [(None, None, None, None, None)] * 3 + [(1, "a", "en", "s", 1)] * 20,
    "two languages of one row": [(1, "A", "en", "s", 1), (2, "b", "de", "s", 1)],
}


@pytest.mark.parametrize("name", CASES)
def test_manifest_is_the_plain_tree(spark, name):
    df = spark.createDataFrame(CASES[name], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumn("pos", F.lit("clash")).withColumn("leaf", F.lit(0))
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    got = merkle.manifest(df, third).drop("path").collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(CASES[name])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.manifest(df).collect() == []


def test_paths_double_their_reach(spark):
    """A chain of n runs: log2(n) joins complete the path of its first run."""
    n = 11
    key = "struct<tree:bigint,level:int,run:bigint>"
    rows = [((0, i, 0), i, (0, i + 1, 0) if i < n - 1 else None, [(str(i), "")] if i < n - 1 else []) for i in range(n)]
    runs = spark.createDataFrame(rows, f"id {key}, level int, up {key}, path array<struct<l:string,r:string>>")
    got = {r["id"]["level"]: (r["up"], [s["l"] for s in r["path"]]) for r in merkle.jump(runs, n).collect()}
    assert got == {i: (None, [str(j) for j in range(i, n - 1)]) for i in range(n)}
