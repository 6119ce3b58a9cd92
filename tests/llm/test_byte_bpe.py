"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakelayer.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_bpe.read_ranks(byte_bpe.vocabulary_file()))


def _encode(df):
    return {r["doc_id"]: (list(r["ids"]), bytes(r["decoded"])) for r in byte_bpe.encode_documents(df).collect()}


def test_ids_are_the_librarys(make_docs, library):
    r = random.Random(3)
    texts = [None, "", "Hello world, it's   a test  \n\n ok 12345 don't 's's '' 'll", "x" * 3000, "日本語テキスト é ñ ß " * 10,
             "ߠ࡯࢈Ա𐵀 ࡰ١٢٣ \x85 　 a b\x1c\x1fc ՘ ꟍ 𖺠 𑷠", "\U0001f600" * 200, "qzjxvkwpfmgybhcdluot" * 20, "\x00 a\x00", "퟿က",
             "<|endoftext|>", " " * 300, "\n" * 50 + " a", "9" * 700]
    texts += ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 0x2FFF), r.randint(0x10000, 0x1FFFF)]))
                      for _ in range(r.randint(1, 60))) for _ in range(100)]
    texts += ["".join(r.choice("aeiotnshr") for _ in range(r.randint(1, 300))) for _ in range(60)]
    got = _encode(make_docs(list(enumerate(texts)), clash=True))
    for i, t in enumerate(texts):
        assert got[i] == (library.encode_ordinary(t or ""), (t or "").encode()), t


def test_awkward_rows(make_docs, awkward, library):
    got = byte_bpe.encode_documents(make_docs(awkward)).collect()
    want = sorted((str(i), library.encode_ordinary(t or "")) for i, t, *_ in awkward)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
    assert byte_bpe.encode_documents(make_docs([])).collect() == []


def test_stretches_are_cut_as_the_whole_text():
    import pyarrow as pa

    r = random.Random(5)
    words_of = byte_bpe.word_pattern(byte_bpe.pattern()).findall
    made = ["", " ", "a b", " a", "a ", "a\nb\n", "a  b", "x\0y z"]
    made += ["".join(r.choice("ab1.'  \n\t\x1c\x85\u3000é's\0") for _ in range(r.randint(0, 12))) for _ in range(3000)]
    for rows in (made, made[:3], ["a b\nc"], []):
        distinct, numbers, ends = byte_bpe.stretches(pa.array(rows, pa.string()))
        names, a = distinct.to_pylist(), 0
        assert len(set(names)) == len(names) and len(ends) == len(rows)
        for t, b in zip(rows, ends):
            assert [w for n in numbers[a:b] for w in words_of(names[n])] == words_of(t), repr(t)
            a = b
        assert a == len(numbers)


def test_the_first_step_begins_anew(monkeypatch):
    """With a small memory and small chunks a task forgets its words; codes stay those of the rows since then."""
    import pyarrow as pa

    monkeypatch.setattr(byte_bpe, "KEPT", 3)
    monkeypatch.setattr(byte_bpe, "CHUNK", 8)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["a b", None, "a c d e", "a b"]})
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("ends", pa.binary()), ("again", pa.bool_()),
                        ("fresh", pa.list_(pa.string()))])
    starts = lambda words: pa.array(words, pa.string())
    got = [r for b in byte_bpe._cut(iter([batch]), byte_bpe.pattern(), {"a": 0}, starts, schema) for r in b.to_pylist()]
    assert [(r["doc_ids"], np.frombuffer(r["codes"], np.int32).tolist(), np.frombuffer(r["ends"], np.int64).tolist(), r["again"], r["fresh"])
            for r in got] == [([1, 2], [0, 1], [2, 2], True, [" b"]), ([3], [0, 2, 3, 4], [4], False, [" c", " d", " e"]),
                              ([4], [0, 1], [2], True, [" b"])]


def test_what_a_task_remembers_is_small():
    """Stretches and words are kept as Arrow arrays: 100000 known and 100000 new words take some MB."""
    import tracemalloc

    import pyarrow as pa

    known = pa.array([f" {i:x}" for i in range(100_000)], pa.string())
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("ends", pa.binary()), ("again", pa.bool_()),
                        ("fresh", pa.list_(pa.string()))])
    letters = str.maketrans("0123456789", "abcdefghij")
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": [
        " ".join(str(i).translate(letters) for i in range(d * 100, d * 100 + 100)) for d in range(1000)]})
    started = tracemalloc.start() or pa.total_allocated_bytes()
    steps = byte_bpe._cut(iter([batch]), byte_bpe.pattern(), known, lambda words: pa.array(words, pa.string()), schema)
    first = next(steps)
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - started - first.nbytes
    tracemalloc.stop()
    assert len(first.column("fresh")[0]) > 90_000
    assert held < 24_000_000


def test_many_bytes_of_stretches_begin_anew(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 100)
    monkeypatch.setattr(byte_bpe, "CHUNK", 8)
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("ends", pa.binary()), ("again", pa.bool_()),
                        ("fresh", pa.list_(pa.string()))])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["a" * 200, "b", "a" * 200]})
    got = [r for b in byte_bpe._cut(iter([batch]), byte_bpe.pattern(), [], lambda words: pa.array(words, pa.string()), schema) for r in b.to_pylist()]
    assert [(r["again"], r["fresh"]) for r in got] == [(True, ["a" * 200]), (True, ["b"]), (False, ["a" * 200])]


def test_words_start_with_their_pieces_and_ranks():
    import pyarrow as pa

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257}
    none, char = byte_bpe._NONE, lambda i: chr(byte_bpe._FIRST + i)
    words = pa.array(["x", "", "abc", "é"]).slice(1)
    assert byte_bpe.Starts(ranks)(words).to_pylist() == [
        {"p": none * 2, "r": none * 2}, {"p": none + "".join(map(char, b"abc")) + none, "r": none + char(256) + char(257) + none * 2},
        {"p": none + "".join(map(char, "é".encode())) + none, "r": none * 4}]


def test_the_ids_of_a_chunk_come_from_its_own_task():
    """_put_together keeps the words of earlier rows and drops them when the first step began anew."""
    import pyarrow as pa

    pieces = byte_bpe.Pieces({bytes([b]): b for b in range(256)})
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def row(docs, codes, ends, again, fresh):
        return pa.RecordBatch.from_arrays([
            pa.array([docs], pa.list_(pa.int64())), pa.array([np.array(codes, np.int32).tobytes()]),
            pa.array([np.array(ends, np.int64).tobytes()]), pa.array([again]), pa.array([fresh], pa.list_(pa.list_(pa.int32())))],
            names=["doc_ids", "codes", "ends", "again", "fresh"])

    known = (np.array([0, 1]), np.array([97], np.int32))
    rows = [row([1, None], [0, 1, 0], [2, 3], True, [[98, 99]]), row([3], [1, 2], [2], False, [[100]]), row([4, 5], [0, 1], [2, 2], True, [[101]])]
    out = [r for b in byte_bpe._put_together(iter(rows), pieces, known, schema) for r in b.to_pylist()]
    assert [(r["doc_id"], r["ids"], r["decoded"]) for r in out] == [
        (1, [97, 98, 99], b"abc"), (None, [97], b"a"), (3, [98, 99, 100], b"bcd"), (4, [97, 101], b"ae"), (5, [], b"")]


def test_pieces_that_no_merges_give_are_refused():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"xyz": 258}
    assert byte_bpe.unreachable(ranks, byte_bpe.pair_ranks(ranks)) == {b"xyz".hex(): 258}


def test_op13(spark, library):
    import __spark_entry__ as entry

    small = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in entry.queries()["op13_byte_bpe"](spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.col("text")).collect()
    assert len(got) == len(rows)
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == want
