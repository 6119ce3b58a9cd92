"""The registered operator queries and the pipeline on whole small tables."""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as entry  # noqa: E402
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def run(key):
        if key not in kept:
            kept[key] = {r["doc_id"]: r for r in entry.queries()[key](spark, SMALL).collect()}
        return kept[key]

    return run


def test_one_query_for_each_operator():
    for n in range(1, 14):
        assert len([k for k in entry.queries() if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in entry.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_op1(result, rows):
    got = result("op1_pii")
    assert len(got) == len(rows)
    for d, t in rows:
        want = brute.base_spans(t or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        r = got[d]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(x[0] == k for x in want) for k in ("email", "ip", "card", "phone")]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)


def test_op3(result, rows):
    from lakelayer.llm.lm_score import ORDER, PRIOR

    want = brute.lm_scores(rows, ORDER, PRIOR)
    for d, r in result("op3_lm_scoring").items():
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[d][:4]
        assert (r["base_score"], r["score"]) == pytest.approx(want[d][4:], abs=1e-6)


def test_op5(result, rows):
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in result("op5_ngram_jaccard_join").items()} == brute.components(rows)


def test_op7(result, rows):
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for d, r in result("op7_suffix_array_dedup").items()} == brute.remove_repeats(rows)


def test_op9(result, rows):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    got = result("op9_exact_dedup")
    want = duckdb.sql(entry.oracle_sql()["op9_exact_dedup"])
    names = want.columns
    assert sorted(tuple(r[n] for n in names) for r in got.values()) == sorted(want.fetchall())
    for d, t in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        assert got[d]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op2_and_op10(result, rows):
    shards = result("op2_sharding")
    assert {d: (r["size"], r["text_crc32"]) for d, r in shards.items()} == {
        d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows}
    langs = result("op10_language_id")
    assert {d: r["held_out"] for d, r in langs.items()} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in rows}


def test_pipeline_is_the_stages_one_after_the_other(spark, result, rows):
    accepted = {d for d, r in result("op8_quality_classifier").items() if r["accepted"]}
    left = [(d, t) for d, t in rows if d in accepted]
    seen, exact = set(), []
    for d, t in sorted(left):
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if text not in seen:
            seen.add(text)
            exact.append((d, t))
    component = brute.components(exact)
    near = [(d, t) for d, t in exact if component[d][1] == d]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute.leaks(near, bench)}
    want = {d: t for d, t in near if d not in leaked}
    got = result("pipeline")
    assert got.keys() == want.keys() and len(want) > len(rows) / 2
    for d, t in want.items():
        assert got[d]["round_trip"] and got[d]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
