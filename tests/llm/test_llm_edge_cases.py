"""Every operator and pipeline stage on awkward rows, empty tables and clashing column names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from lakelayer.llm import (byte_bpe, decontaminate, exact_dedup, language_id, lm_score, merkle, near_dup, pieces, pii, quality,
                           sharding, substring_dedup)


@pytest.fixture(scope="module")
def others(spark, tmp_path_factory):
    """A folder with labels and benchmark tables, nulls and repeats included."""
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, None), (10, 0, 0)],
                          "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "same text twice in two rows of the same id"), (2, None), (3, ""), (None, "one"), (4, "one")],
                          "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def operators(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    return {
        "pii": pii.sanitisation_spans,
        "sharding": sharding.shard_documents,
        "lm_score": lm_score.score_documents,
        "near_dup": near_dup.near_duplicates,
        "pieces": pieces.encoded,
        "substring_dedup": substring_dedup.remove_repeats,
        "quality": lambda d: quality.classify(d, labels),
        "exact_dedup": exact_dedup.exact_dedup,
        "language_id": lambda d: language_id.identify(d, language_id.learn_dictionaries(d)),
        "decontaminate": lambda d: decontaminate.find_leaks(d, benchmark),
        "merkle": merkle.manifest,
        "byte_bpe": byte_bpe.encode_documents,
    }


NAMES = ["pii", "sharding", "lm_score", "near_dup", "pieces", "substring_dedup", "quality", "exact_dedup", "language_id",
         "decontaminate", "merkle", "byte_bpe"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, make_docs, awkward, others, name):
    got = operators(spark, others)[name](make_docs(awkward, clash=True)).collect()
    if name == "decontaminate":
        # the empty and null items match nothing, the one-word item the one-word text
        assert sorted((r["doc_id"], r["item_id"] or 0) for r in got) == [(4, 0), (4, 4), (6, 1), (6, 1), (7, 1)]
    else:
        want = [r[0] for r in awkward]
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted(
            (i is not None, i or 0) for i in want)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, make_docs, others, name):
    assert operators(spark, others)[name](make_docs([])).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_nulls_only(spark, make_docs, others, name):
    got = operators(spark, others)[name](make_docs([(None, None, None, None), (1, None, None, None)])).collect()
    assert len(got) == (0 if name == "decontaminate" else 2)


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages(spark, make_docs, awkward, others, stage):
    f = dict(corpus_pipeline.STAGES)[stage]
    docs = make_docs(awkward, clash=True)
    out = f(spark, docs, others)
    got = out.collect()
    ids = [r["doc_id"] for r in got]
    if stage != "encode":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert None in ids
    if stage == "exact_dedup":
        # null, empty and blank texts: the empty ones are equal, a blank one becomes one space
        assert 2 not in ids and 7 not in ids and {1, 3, 4, 6} <= set(ids)
    if stage == "near_dedup":
        assert 7 not in ids and 9 not in ids and {1, 2, 3, 4, 6, 8} <= set(ids)
    if stage == "decontaminate":
        assert not {4, 6, 7} & set(ids) and {1, 2, 3, 8} <= set(ids)
    if stage == "encode":
        assert len(got) == len(awkward) and all(r["round_trip"] for r in got)
    assert f(spark, make_docs([]), others).collect() == []
