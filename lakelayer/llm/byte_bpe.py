r"""Byte-level BPE encoding and decoding; the merges are folded by Spark's higher-order functions.

One pass over the documents, without a shuffle of their texts. Three steps follow each other in a task:

1. Words (Arrow). Texts are cut by the tokenizer's pattern, each distinct stretch between white
   space once. Each chunk of documents (some MB)
   becomes one row: the words that the task has not met before, and per document the numbers
   of its words.
2. Fold (column expressions). ``transform`` over the array of distinct words; each word is an
   array of bytes, one character a piece, held as a text, with the ranks of its byte pairs. ``aggregate`` folds the ranked
   merges over it: a step joins the neighbours of the lowest rank, leftmost first, and looks
   up the two pairs that arise. Ranks come from a literal map of the vocabulary, dealt over
   buckets so that a lookup reads some entries and not all. A word of more than ``LONG``
   pieces joins every place of the lowest rank in one step if no pair that arises ranks lower
   (else one place), which gives the same pieces.
3. Ids (Arrow). The ids of the words, those of earlier rows of the task included, are put
   together for each document. Decoding concatenates the byte pieces of the ids.

The tasks begin with ``FREQUENT`` words folded before, the most frequent of a bounded sample of
documents; whichever words these are, the result is the same, as all others are folded in the tasks.

A piece is known by its id, as the rank of a piece is its id. A pair is any two pieces whose
bytes together are a piece, as the library looks pairs up by bytes.

Defined cases: a null or empty text has no tokens and decodes to no bytes; null and repeated
ids are kept; an empty table gives an empty result; extra columns are ignored. A task keeps
``KEPT`` stretches or ``KEPT_BYTES`` of them, as Arrow arrays, and then begins anew. A run of equal characters takes few steps, but a run
of many thousand random letters without a space or digit takes one for each of its ranks.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .arrow import gather, prepare
from .registry import register, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
KEPT = 1 << 20  # distinct stretches between white space a task remembers
KEPT_BYTES = 1 << 26  # of these stretches
CHUNK = 1 << 20  # characters of text to a row of the first step
LONG = 96  # pieces; a longer word joins many places in a step
FREQUENT = 1 << 18  # words folded once for all tasks
SAMPLE = 16384  # documents whose words these are, about
WORD_BYTES = 64  # of such a word, at most
_START = pa.struct([("p", pa.string()), ("r", pa.string())])
SPARK_SEED = 42  # of Spark's xxhash64
_FIRST = 0x1000  # piece i is the character _FIRST + i, below the surrogates
_APART = "\0"
#: Texts that are empty, begin or end with white space, hold two of it in a row, or other than blanks and line feeds.
_UNEVEN = (r"\A\z|\A[ \n]|[ \n]\z|[ \n][ \n]|[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
           r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_NONE = "퟿"  # no piece, no rank; above all others


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks a byte")
    if max(ranks.values()) + _FIRST >= ord(_NONE):
        raise ValueError("the vocabulary is too large")
    return ranks


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The rank of every two pieces that are a piece together."""
    return {(ranks[p[:i]], ranks[p[i:]]): r for p, r in ranks.items() for i in range(1, len(p))
            if p[:i] in ranks and p[i:] in ranks}


def unreachable(ranks: dict[bytes, int], pairs: dict[tuple[int, int], int]) -> dict[str, int]:
    """Pieces that merging their own bytes does not give; a word that is one of them is that piece all the same."""
    out = {}
    for piece, rank in ranks.items():
        ids = [ranks[piece[i: i + 1]] for i in range(len(piece))]
        while len(ids) > 1:
            best, at = min((pairs.get(p, 1 << 30), i) for i, p in enumerate(zip(ids, ids[1:])))
            if best == 1 << 30:
                break
            ids[at: at + 2] = [best]
        if ids != [rank]:
            out[piece.hex()] = rank
    return out


# ------------------------------------------------------------------ words

@cache
def compiled(expression: str):
    import regex

    return regex.compile(expression, regex.V1)


@cache
def word_pattern(expression: str):
    """``expression`` compiled; characters that the library's Unicode tables do not count as letters or
    digits, but the newer tables here do, are taken out of the classes (both are asked about all). The driver
    does this once; tasks compile the pattern it gives."""
    import regex
    import tiktoken

    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        ours: set[str] = set()
        theirs: set[str] = set()
        for start in range(0, 0x110000, 0x10000):
            some = "".join(chr(i) for i in range(start, start + 0x10000) if not 0xD800 <= i < 0xE000)
            theirs.update(bytes(probe.encode_ordinary(some)).decode())
            ours.update(regex.findall(name, some))
        if theirs - ours:
            raise ValueError(f"characters of {name} are unknown here")
        spans: list[list[int]] = []
        for c in sorted(map(ord, ours - theirs)):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
        if spans:
            gone = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
            mark = "\0"
            expression = expression.replace(name, mark).replace(f"?{mark}", f"?[{mark}]").replace(mark, f"[{name}--[{gone}]]")
    return compiled(expression)


def _number(keys: pa.StringArray, known: pa.StringArray) -> tuple[np.ndarray, pa.StringArray]:
    """(number of each of the distinct ``keys``, those that are new); the new ones follow the known ones. The keys
    are hashed, not the known ones, which are many."""
    place = pc.fill_null(pc.index_in(known, value_set=keys), -1).to_numpy(zero_copy_only=False)
    met = np.flatnonzero(place >= 0)
    numbers = np.full(len(keys), -1, np.int64)
    numbers[place[met]] = met
    new = numbers < 0
    numbers[new] = len(known) + np.arange(np.count_nonzero(new))
    return numbers, keys.filter(pa.array(new))


def _release() -> None:
    """Give back to the system what Arrow and numpy have freed; a worker lives on after its task, in either step."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def stretches(rows: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(distinct stretches, number of each stretch of all texts, running end of each text). A stretch begins
    with white space, or with the text. No match of the pattern reaches from a character over the white space
    after it, so stretches can be cut on their own."""
    plain = pc.invert(pc.match_substring_regex(rows, _UNEVEN))
    marked = rows.filter(plain)
    for white in " \n":
        marked = pc.replace_substring(marked, white, _APART + white)
    cut = pc.split_pattern(marked, _APART)
    odd = pa.array(map(_stretch().findall, rows.filter(pc.invert(plain)).to_pylist()), pa.list_(pa.string()))
    both = pa.concat_arrays([cut.flatten(), odd.flatten()]).dictionary_encode()
    sizes = pa.concat_arrays([cut.value_lengths(), odd.value_lengths()]).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    place = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")  # the plain texts came first
    which = np.empty(len(place), np.int64)
    which[place] = np.arange(len(place))
    numbers, ends = gather(both.indices.to_numpy(zero_copy_only=False), starts, which)
    return both.dictionary, numbers, ends


@cache
def _stretch():
    import regex

    return regex.compile(r"\s*\S+|\s+")


class Starts:
    """A word as the fold begins with it: its bytes as pieces, and the rank of each with the next one."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.pieces = np.array([_FIRST + ranks[bytes([b])] for b in range(256)], np.int32)
        self.ranks = np.full((256, 256), ord(_NONE), np.int32)
        for p, r in ranks.items():
            if len(p) == 2:
                self.ranks[p[0], p[1]] = _FIRST + r

    def __call__(self, words: pa.StringArray) -> pa.StructArray:
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(pc.cast(words, pa.binary()).to_pylist()), np.uint8)
        at = np.arange(len(data)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1  # _NONE before and after each word
        ends = np.concatenate([[0], np.cumsum(sizes + 2)])
        p, r = (np.full(ends[-1], ord(_NONE), np.int32) for _ in range(2))
        p[at] = self.pieces[data]
        r[at[:-1]] = np.where(np.diff(at) == 1, self.ranks[data[:-1], data[1:]], ord(_NONE))
        return pa.StructArray.from_arrays([_of_characters(p, ends), _of_characters(r, ends)], ["p", "r"])


def _of_characters(codes: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """Texts of characters that take three bytes each (0x800 to 0xFFFF)."""
    utf8 = np.empty((len(codes), 3), np.uint8)
    utf8[:, 0], utf8[:, 1], utf8[:, 2] = 0xE0 | codes >> 12, 0x80 | codes >> 6 & 0x3F, 0x80 | codes & 0x3F
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer((3 * ends).astype(np.int32)), pa.py_buffer(utf8))


class _Cutter:
    """Texts to numbers of words. A stretch met before is not cut again; the words known at first, which the
    pattern leaves whole, are stretches as well. Stretches and words are looked up by Arrow, all of a chunk at once:
    kept as Python's texts and numbers they take ten times the memory."""

    def __init__(self, expression: str, known: pa.StringArray) -> None:
        self.words_of, self.known = compiled(expression).findall, known
        self.begin()

    def begin(self) -> None:
        self.words = self.whole = self.known
        self.codes = np.arange(len(self.known), dtype=np.int32)  # numbers of the words of all stretches met
        self.ends = np.arange(len(self.known) + 1)

    def full(self) -> bool:
        return len(self.whole) - len(self.known) > KEPT or self.whole.nbytes - self.known.nbytes > KEPT_BYTES

    def __call__(self, rows: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
        """(numbers of the words of all rows, running end of each row, words that are new)."""
        distinct, numbers, row_ends = stretches(rows)
        met, new = _number(distinct, self.whole)
        cut = [self.words_of(s) for s in new.to_pylist()]
        words = pa.array([w for some in cut for w in some], pa.string()).dictionary_encode()
        own, fresh = _number(words.dictionary, self.words)
        self.codes = np.concatenate([self.codes, own[words.indices.to_numpy(zero_copy_only=False)].astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(some) for some in cut], dtype=np.int64)])
        self.whole, self.words = pa.concat_arrays([self.whole, new]), pa.concat_arrays([self.words, fresh])
        codes, ends = gather(self.codes, self.ends, met[numbers])
        return codes, np.concatenate([[0], ends])[row_ends].astype(np.int64), fresh


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Slices of at most ``CHUNK`` characters, or of one text."""
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > CHUNK:
            yield start, i
            start, size = i, 0
        size += n
    if lengths:
        yield start, len(lengths)


def _texts(column: pa.Array) -> pa.StringArray:
    return column.cast(pa.string()).fill_null("")


def _counts(batches: Iterator[pa.RecordBatch], expression: str) -> Iterator[pa.RecordBatch]:
    words_of = compiled(expression).findall
    for b in batches:
        distinct, numbers, _ = stretches(_texts(b.column("text")))
        n: dict[str, int] = {}
        for s, k in zip(distinct.to_pylist(), np.bincount(numbers, minlength=len(distinct)).tolist()):
            for w in words_of(s):
                n[w] = n.get(w, 0) + k
        n = {w: k for w, k in n.items() if len(w.encode()) <= WORD_BYTES}
        yield pa.RecordBatch.from_pydict({"word": pa.array(n, pa.string()), "n": pa.array(n.values(), pa.int64())})


def _cut(batches: Iterator[pa.RecordBatch], expression: str, known: pa.StringArray, starts: Starts,
         out_type: pa.Schema) -> Iterator[pa.RecordBatch]:
    cut, again = _Cutter(expression, pa.array(known, pa.string())), True
    for b in batches:
        rows = _texts(b.column("text"))
        for x, y in _chunks(pc.utf8_length(rows).to_pylist()):
            if cut.full():
                cut.begin()
                again = True
            codes, ends, fresh = cut(rows.slice(x, y - x))
            ids = b.column("doc_id").slice(x, y - x)
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([codes.tobytes()], pa.binary()), pa.array([ends.tobytes()], pa.binary()),
                pa.array([again]), pa.ListArray.from_arrays(pa.array([0, len(fresh)], pa.int32()), starts(fresh))],
                schema=out_type)
            again = False
            _release()


# ------------------------------------------------------------------ the fold

Lookup = Callable[[Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


class LiteralMap:
    """A map from text to text as a literal of an expression: entries dealt over buckets by the key's hash."""

    def __init__(self, entries: dict[str, str]) -> None:
        self.size = 1 << max(len(entries) // 4, 1).bit_length()
        dealt: list[dict[str, str]] = [{} for _ in range(self.size)]
        for k, v in entries.items():
            dealt[xxhash.xxh64_intdigest(k.encode(), SPARK_SEED) % self.size][k] = v
        self.buckets = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,string>>")

    def bound(self, body: Callable[[Lookup], Column]) -> Column:
        """``body`` of a lookup (null for an absent key). However often ``body`` looks up, the expression
        holds the literal once."""
        def lookup(buckets: Column) -> Lookup:
            return lambda key: F.get(buckets, F.xxhash64(key).bitwiseAND(F.lit(self.size - 1)).cast("int"))[key]

        return let(self.buckets, lambda buckets: body(lookup(buckets)))


def _ranks_of(pieces: Column, rank: Lookup) -> Column:
    """For each character of ``pieces`` its rank with the next one, as a text of the same length."""
    def chars(c: Column) -> Column:
        return F.transform(c, lambda x, i: F.coalesce(rank(F.concat(x, F.get(c, i + 1))), F.lit(_NONE)))

    few = F.transform(F.sequence(F.lit(1), F.length(pieces)), lambda i: F.coalesce(rank(F.substring(pieces, i, F.lit(2))), F.lit(_NONE)))
    return F.array_join(F.when(F.length(pieces) <= LONG, few).otherwise(let(F.split(pieces, ""), chars)), "")


def _join_one(s: Column, best: Column, rank: Lookup) -> Column:
    """The leftmost pair of rank ``best`` joined. Pieces and ranks begin and end with ``_NONE``."""
    look = lambda key: F.coalesce(rank(key), F.lit(_NONE))

    def at(i: Column) -> Column:
        def joined(p: Column) -> Column:
            arise = F.concat(look(F.substring(p, i - 1, F.lit(2))), look(F.substring(p, i, F.lit(2))))
            return F.struct(p.alias("p"), F.overlay(s["r"], arise, i - 1, F.lit(3)).alias("r"))

        return let(F.overlay(s["p"], best, i, F.lit(2)), joined)

    return let(F.instr(s["r"], best), at)


def _join_all(s: Column, best: Column, rank: Lookup) -> Column:
    """All pairs of rank ``best`` joined, from the left and without overlap."""
    pair = F.substring(s["p"], F.instr(s["r"], best), F.lit(2))
    return let(F.replace(s["p"], pair, best), lambda q: F.struct(q.alias("p"), _ranks_of(q, rank).alias("r")))


def fold(start: Column, rank: Lookup) -> Column:
    """The ids of one word (an array of int), given as ``Starts`` gives it. The state holds the least rank
    (empty: none), so that the steps left when a word is done look at nothing."""
    least = lambda s: F.array_min(F.split(F.replace(s["r"], F.lit(_NONE), F.lit("")), ""))

    def ranked(s: Column) -> Column:
        return let(s, lambda t: F.struct(t["p"].alias("p"), t["r"].alias("r"), least(t).alias("best")))

    def one(s: Column, _: Column) -> Column:
        return F.when(s["best"] == "", s).otherwise(ranked(_join_one(s, s["best"], rank)))

    def many(s: Column, _: Column) -> Column:
        return F.when(s["best"] == "", s).otherwise(let(ranked(_join_all(s, s["best"], rank)), lambda t: F.when(
            (t["best"] != "") & (t["best"] < s["best"]), ranked(_join_one(s, s["best"], rank))).otherwise(t)))

    def ids(s: Column) -> Column:
        return F.transform(F.split(F.substring(s["p"], F.lit(2), F.length(s["p"]) - 2), ""), lambda c: F.ascii(c) - _FIRST)

    size = F.length(start["p"])
    steps = F.sequence(F.lit(1), F.greatest(size - 3, F.lit(1)))  # a word of n bytes is joined n - 1 times at most
    return F.when(size <= LONG, F.aggregate(steps, ranked(start), one, ids)).otherwise(F.aggregate(steps, ranked(start), many, ids))


# ------------------------------------------------------------------ ids

class Pieces:
    """The bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        by_id = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = piece
        self.by_id = pa.array(by_id, pa.binary())

    def decode(self, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """(bytes of all ids, where each id begins, and the end of the last)."""
        got = self.by_id.take(pa.array(ids))
        _, ends, data = got.buffers()
        return data or pa.py_buffer(b""), np.frombuffer(ends, np.int32)[: len(got) + 1] if len(got) else np.zeros(1, np.int32)


def _put_together(batches: Iterator[pa.RecordBatch], pieces: Pieces, known: tuple[np.ndarray, np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    starts, ids = known
    for b in batches:
        for r in range(b.num_rows):
            fresh = b.column("fresh").slice(r, 1).flatten()
            if b.column("again")[r].as_py():
                starts, ids = known
            lengths = fresh.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([starts, starts[-1] + np.cumsum(lengths)])
            ids = np.concatenate([ids, fresh.flatten().to_numpy(zero_copy_only=False).astype(np.int32)])
            codes = np.frombuffer(b.column("codes")[r].as_py(), np.int32)
            text_ends = np.frombuffer(b.column("ends")[r].as_py(), np.int64)
            own, ends = gather(ids, starts, codes)
            offsets = np.concatenate([[0], np.concatenate([[0], ends])[text_ends]])
            data, data_ends = pieces.decode(own)
            data_offsets = data_ends[offsets]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_ids").slice(r, 1).flatten(),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(own, pa.int32())),
                pa.Array.from_buffers(pa.binary(), len(text_ends),
                                      [None, pa.py_buffer(data_offsets), data])], schema=schema)
            del codes, text_ends, own, ends, offsets, data, data_ends, data_offsets
            _release()


def encode_documents(docs: DataFrame, path: str | None = None, expression: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded (the bytes that the ids give back)."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    expression = word_pattern(expression or pattern()).pattern
    ranks = read_ranks(path or vocabulary_file())
    pairs = pair_ranks(ranks)
    chars = {r: chr(_FIRST + r) for r in ranks.values()}
    rank_map = LiteralMap({chars[a] + chars[b]: chars[r] for (a, b), r in pairs.items()})
    if unreachable(ranks, pairs):
        raise ValueError("the vocabulary holds pieces that no merges give")
    pieces, starts = Pieces(ranks), Starts(ranks)

    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    arrow_id = rows.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    cut_schema = pa.schema([("doc_ids", pa.list_(arrow_id)), ("codes", pa.binary()), ("ends", pa.binary()),
                            ("again", pa.bool_()), ("fresh", pa.list_(_START))])
    out_schema = pa.schema([("doc_id", arrow_id), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def folded(words: Column) -> Column:
        return rank_map.bound(lambda rank: F.transform(words, lambda w: fold(w, rank)))

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = compiled(expression).findall
        for b in batches:
            words = pa.array([w for w in b.column("word").to_pylist() if words_of(w) == [w]], pa.string())
            yield pa.RecordBatch.from_arrays([words, starts(words)], ["word", "start"])

    sample = rows.sample(min(1.0, SAMPLE / max(rows.count(), 1)), seed=0)
    counted = sample.mapInArrow(lambda it: _counts(it, expression), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").repartition(shuffle_partitions(spark))
    top = top.mapInArrow(started, "word string, start struct<p:string,r:string>")
    frequent = top.select("word", folded(F.array("start"))[0].alias("ids")).toArrow()
    lengths = frequent["ids"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if frequent.num_rows else []
    known = spark.sparkContext.broadcast(pa.array(frequent["word"].to_pylist(), pa.string()))
    known_ids = spark.sparkContext.broadcast((np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
                                              np.array(frequent["ids"].combine_chunks().flatten(), np.int32)))

    cut = rows.mapInArrow(lambda it: _cut(it, expression, known.value, starts, cut_schema),
                          f"doc_ids array<{id_type}>, codes binary, ends binary, again boolean, fresh array<struct<p:string,r:string>>")
    return cut.withColumn("fresh", folded(F.col("fresh"))).mapInArrow(
        lambda it: _put_together(it, pieces, known_ids.value, out_schema), f"doc_id {id_type}, ids array<int>, decoded binary")


@register("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.replace(F.col("ids").cast("string"), F.lit(", "), F.lit(","))  # [1,2,3]
    return encode_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.substring(ids, F.lit(2), F.length(ids) - 2), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
