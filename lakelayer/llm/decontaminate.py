r"""Benchmark decontamination: SimHash windows, a multi-index Hamming search, an exact check.

A document leaks an item of n words when some window of n words of it (the document, where
that is shorter) reaches weighted-shingle similarity ``SIMILARITY`` with the item: over
five-word shingles with their counts, sum of minima over sum of maxima (a text under five
words is one shingle). Words are lower-cased ``[^\x20\x09-\x0D]+``.

* A leak has a run of words in common with its item, however the edits lie; ``least_run``
  gives its least length. Items fall into bands by it. A band has a window length and a
  stride that fit into the run together, so that it holds a whole strided window of the
  document. Every window of an item (stride 1) and every strided window of a document gets
  a 64-bit SimHash over its word pairs; that of the window in the run is the item's own.
* The items' fingerprints are indexed once per block of bits. ``RADIUS + 1`` blocks
  guarantee that fingerprints within the radius share a block, so the search finds all of
  them.
* Every candidate is checked exactly: all item-sized windows around the matching one. So
  the result is that of comparing every window with every item.

Benchmarks are indexed in blocks of ``BLOCK_ITEMS`` items, a size every task can hold; a
larger one takes one pass per block. Documents are never shuffled: the result has a row per
document and leaked item.

Defined cases: null or empty texts, of documents or items, match nothing; null or repeated
ids are matched row by row; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrow import map_batches, texts
from .bounded import counted, filtered
from .mail import chained
from .registry import register, table

SIMILARITY = 0.8
SHINGLE = 5
RADIUS = 7
BLOCK_ITEMS = 20_000
CHUNK_WORDS = 40_000
RESULT = "item_id {item}, similarity double, start_word bigint, item_words bigint"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes]) -> Counter:
    return Counter(tuple(words[i: i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle counts."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def least_run(words: list[bytes]) -> int:
    """Words in a row that every window similar to the item of these words surely shares with it.

    Of N and M shingles (M <= N: a document may be shorter) at least 4/9 (N + M) are common.
    Where all k-grams of the item are distinct, common shingles of a window that overlap in k
    words lie alike in the item, so a break in the run costs 5 - k shingles.
    """
    n = len(words)
    if n < SHINGLE:
        return n
    grams = (len(set(zip(*(words[i:] for i in range(k))))) == n - k + 1 for k in range(1, SHINGLE))
    cost = next((SHINGLE - k for k, distinct in enumerate(grams, 1) if distinct), 0)
    if not cost:
        return SHINGLE  # any order of the shingles may be a leak
    size = n - SHINGLE + 1
    runs = []
    for other in range(-(-4 * size // 5), size + 1):
        common = -(-4 * (size + other) // 9)
        runs.append(-(-common // ((other - common) // cost + 1)))
    return min(runs) + SHINGLE - 1


def band_of(words: list[bytes]) -> tuple[int, int, int]:
    """(least run of the band, window length, stride) for an item of these words."""
    run, low = least_run(words), 1
    while (step := max(low + 1, low * 5 // 4)) <= run:
        low = step
    stride = 1 if low < 8 else int(0.3 * low)
    return (low, low - stride + 1, stride)


def best_window(words: list[bytes], n: int, wanted: Counter, around: set[int]) -> tuple[float, int]:
    """(similarity, -start) of the best window of n words at the starts ``around``, the first on ties."""
    n = min(n, len(words))
    width = min(n, SHINGLE)
    count = n - width + 1
    total = sum(wanted.values()) + count
    best, held, both, before = (-1.0, 0), Counter(), 0, None
    for a in sorted({min(a, len(words) - n) for a in around}):
        if before is None or a != before + 1:
            held, both, new = Counter(), 0, range(a, a + count)
        else:
            new = (a + count - 1,)
            gone = tuple(words[before: before + width])
            if gone in wanted:
                both -= held[gone] <= wanted[gone]
                held[gone] -= 1
        for i in new:
            gram = tuple(words[i: i + width])
            if gram in wanted:
                both += held[gram] < wanted[gram]
                held[gram] += 1
        best, before = max(best, (both / (total - both), -a)), a
    return best


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class PairHashes:
    """Hashes of words, kept by word up to a bound."""

    def __init__(self, held: int = 500_000) -> None:
        self.held, self.known = held, _Known()

    def words(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.held:
            self.known = _Known()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def bit_sums(words: np.ndarray) -> np.ndarray:
    """Row i: for each of 64 bits, how many of the first i word pairs have it, as the bytes of 8 numbers
    that carry over; the difference of two rows is exact while no count in it exceeds 255."""
    pairs = chained(words[:-1], words[1:]) if len(words) > 1 else np.zeros(0, np.uint64)
    out = np.zeros((len(pairs) + 1, 8), np.uint64)
    if len(pairs):
        np.cumsum(np.unpackbits(pairs.view(np.uint8)).view(np.uint64).reshape(-1, 8), axis=0, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, starts: np.ndarray, length: int, words: np.ndarray) -> np.ndarray:
    """SimHash of the windows of ``length`` words (256 at most) at ``starts``."""
    if length == 1:
        return chained(words[starts], words[starts])
    ones = (sums[starts + length - 1] - sums[starts]).view(np.uint8)
    return np.packbits(ones > (length - 1) // 2, axis=1).view(np.uint64).ravel()


class HammingIndex:
    """All stored fingerprints within ``radius`` of a query, by more than radius blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        blocks = max(radius + 1, 4)  # of 16 bits at most, for the tables
        edges = [64 * i // blocks for i in range(blocks + 1)]
        self.blocks = []
        for a, b in zip(edges, edges[1:]):
            shift, mask = np.uint64(a), np.uint64((1 << (b - a)) - 1)
            own = (prints >> shift) & mask
            order = np.argsort(own, kind="stable")
            first = np.searchsorted(own[order], np.arange((1 << (b - a)) + 1, dtype=np.uint64))
            self.blocks.append((shift, mask, order, prints[order], first))

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query index, stored index) of every pair within the radius, each once."""
        found = []
        for shift, mask, order, prints, first in self.blocks:
            key = ((queries >> shift) & mask).astype(np.int64)
            count = first[key + 1] - first[key]
            ends = np.cumsum(count)
            at = np.repeat(first[key] - (ends - count), count)
            at += np.arange(len(at))
            close = np.flatnonzero(np.bitwise_count(np.repeat(queries, count) ^ prints[at]) <= self.radius)
            found.append(np.searchsorted(ends, close, "right") * len(self.prints) + order[at[close]])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


class ItemIndex:
    """The items of a benchmark block, with a Hamming index per band."""

    def __init__(self, items: list[tuple]) -> None:
        """items: (id, text)."""
        self.hashes = PairHashes()
        self.items = [(i, w, shingles(w)) for i, t in items if (w := words_of(t))]
        bands: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
        for at, (_, w, _) in enumerate(self.items):
            band = band_of(w)
            hashed = self.hashes.words(w)
            starts = np.arange(len(w) - band[1] + 1)
            for offset, p in enumerate(fingerprints(bit_sums(hashed), starts, band[1], hashed)):
                bands.setdefault(band, []).append((int(p), at, offset))
        self.bands = []
        for (_, length, stride), rows in bands.items():
            p, at, offset = (np.array(x, t) for x, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            self.bands.append((length, stride, HammingIndex(p), at, offset))

    def leaks(self, batch: list[str]) -> list[tuple[int, int, float, int]]:
        """(text index, item index, similarity, first word) of every leak, the best window of each."""
        out, chunk, held = [], [], 0
        for i, t in enumerate(batch):
            w = words_of(t)
            chunk.append((i, w))
            held += len(w)
            if held >= CHUNK_WORDS:
                out += self._leaks(chunk)
                chunk, held = [], 0
        return out + self._leaks(chunk)

    def _leaks(self, chunk: list[tuple[int, list[bytes]]]) -> list[tuple[int, int, float, int]]:
        flat = [x for _, w in chunk for x in w]
        if not flat:
            return []
        hashed = self.hashes.words(flat)
        sizes = np.array([len(w) for _, w in chunk])
        heads = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(chunk)), sizes)
        sums = bit_sums(hashed)
        starts_of: dict[tuple[int, int], set[int]] = {}
        for length, stride, index, items, offsets in self.bands:
            starts = np.arange(0, len(flat) - length + 1, stride)
            starts = starts[owner[starts] == owner[starts + length - 1]]
            # a short text may lie between the strides: its first window counts as well
            short = heads[(sizes >= length) & (sizes < length + stride)]
            starts = np.union1d(starts, short)
            q, s = index.near(fingerprints(sums, starts, length, hashed))
            for window, stored in zip(starts[q].tolist(), s.tolist()):
                own = int(owner[window])
                n = len(self.items[items[stored]][1])
                around = range(max(0, window - int(heads[own]) + length - n), window - int(heads[own]) + 1)
                starts_of.setdefault((own, int(items[stored])), set()).update(around)
        out = []
        for (own, item), around in starts_of.items():
            i, words = chunk[own]
            _, item_words, wanted = self.items[item]
            best = best_window(words, len(item_words), wanted, around)
            if best[0] >= SIMILARITY:
                out.append((i, item, best[0], -best[1]))
        return out


def _block(docs: DataFrame, items: list[tuple], item_type: str) -> DataFrame:
    ready: list[ItemIndex] = []  # one per Python worker and block
    arrow_type = pa.int64() if item_type in ("bigint", "int") else pa.string()

    def find(b: pa.RecordBatch) -> pa.RecordBatch | None:
        if not ready:
            ready.append(ItemIndex(items))
        found = ready[0].leaks(texts(b))
        if not found:
            return None
        kept = [ready[0].items[f[1]] for f in found]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array([f[0] for f in found])), pa.array([k[0] for k in kept], arrow_type),
             pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64()),
             pa.array([len(k[1]) for k in kept], pa.int64())],
            ["doc_id", "item_id", "similarity", "start_word", "item_words"])

    types = f"doc_id {dict(docs.dtypes)['doc_id']}, " + RESULT.format(item="bigint" if arrow_type == pa.int64() else "string")
    return map_batches(docs.select("doc_id", "text"), find, types)


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, start_word, item_words: a row per row of ``docs`` and item it leaks."""
    spark = docs.sparkSession
    item_type = dict(benchmark.dtypes)["item_id"]
    items = benchmark.select(F.col("item_id").cast("bigint" if item_type in ("bigint", "int") else "string"), "text")
    blocks = max(1, -(-items.count() // block_items))
    if blocks == 1:
        return _block(docs, [tuple(r) for r in items.collect()], item_type)  # block_items rows at most
    path = scratch_path(spark, "leaks")
    numbered = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for i in range(blocks):
        one = numbered.where(F.col("_block") == i).drop("_block")
        _block(docs, [tuple(r) for r in one.collect()], item_type).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that leak an item; all columns stay. Rows that share an id (or have none) are
    judged each by its own text."""
    row = F.xxhash64("text").alias("row")
    leaked = find_leaks(docs.select(F.struct("doc_id", row).alias("doc_id"), "text"), benchmark).select("doc_id.*").distinct()
    return filtered(docs, counted(leaked), [F.col("doc_id"), row], "left_anti")


@register("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
