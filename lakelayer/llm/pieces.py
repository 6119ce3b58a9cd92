"""SentencePiece encoding and decoding over a suffix array of the batch.

The given model (a parameter; never trained here) holds pieces merged by score (its type
is BPE, with byte fallback, an identity normaliser and a leading space mark). For every
Arrow batch:

1. Texts are cut before each run of space marks. No piece reaches over such a cut, which
   is checked when the model is read, so the stretches encode on their own and each
   distinct stretch is encoded once (a bounded cache keeps them for later batches).
2. The distinct stretches are joined into one buffer, and a suffix array sorts its
   positions by their next bytes.
3. Every piece is binary-searched for its range of occurrences. The occurrences are the
   edges (from, to, piece); they are sorted by position.
4. Relaxation. A model that merges by score does not choose the path with the best
   total, so a shortest path would give other ids than the model's. Instead edges are
   contracted: in each round, every stretch takes its best applicable edge (highest
   score, then leftmost), one that joins exactly two current symbols, until none is
   left. That is the model's own rule. Long stretches do the same with a heap.

Characters without a piece become their bytes' tokens. Decoding joins the pieces' bytes.

Defined cases: a null or empty text has no tokens and decodes to an empty text; a space
mark inside a text decodes as a space, as the model defines; null and repeated ids are
kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import gather, map_batches, texts
from .registry import register, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 400_000
LONG = 64  # bytes; longer stretches are contracted with a heap
SEPARATOR = b"\xff"  # in no UTF-8 text, so no piece reaches over it
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class PieceModel:
    pieces: list[bytes]  # by id; empty for control tokens
    ranks: np.ndarray  # by id: 0 is the best score
    byte_ids: np.ndarray  # by byte value


def read_model(path: str = MODEL_FILE) -> PieceModel:
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    t, n = m.trainer_spec, m.normalizer_spec
    if t.model_type != t.BPE or not t.byte_fallback or n.precompiled_charsmap or not n.add_dummy_prefix \
            or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError("only BPE models with byte fallback, identity normaliser and space marks are supported")
    pieces, scores, byte_ids = [], [], np.full(256, -1, np.int32)
    for i, p in enumerate(m.pieces):
        if p.type == p.BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = i
        normal = p.type == p.NORMAL
        if normal and MARK in p.piece.lstrip(MARK):
            raise ValueError("a piece reaches over the start of a word")
        pieces.append(p.piece.encode() if normal else b"")
        scores.append(p.score)
    _, ranks = np.unique(-np.array(scores), return_inverse=True)
    return PieceModel(pieces, ranks.astype(np.int64), byte_ids)


def _big_endian_words(buffer: np.ndarray, at: int) -> np.ndarray:
    """For every position, bytes [at, at + 8) after it as one sortable number."""
    padded = np.concatenate([buffer, np.zeros(at + 8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded[at:], 8)[: len(buffer)]
    return np.ascontiguousarray(windows).view(">u8").ravel().astype(np.uint64)


class PieceKeys:
    """Per piece: the least and the greatest suffix that begins with it, as two words each."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces])
        word = lambda pad, at: np.array(
            [int.from_bytes(p[at: at + 8].ljust(8, pad), "big") for p in pieces], np.uint64)
        self.low, self.high = (word(b"\0", 0), word(b"\0", 8)), (word(b"\xff", 0), word(b"\xff", 8))


class SuffixIndex:
    """Suffix array of a buffer by the first 16 bytes of each suffix."""

    def __init__(self, buffer: np.ndarray) -> None:
        self.buffer = buffer
        first, second = _big_endian_words(buffer, 0), _big_endian_words(buffer, 8)
        self.order = np.lexsort((second, first))
        self.first, self.second = first[self.order], second[self.order]

    def occurrences(self, keys: PieceKeys) -> tuple[np.ndarray, np.ndarray]:
        """(positions, index into the pieces) of every occurrence of every piece."""
        lo = np.searchsorted(self.first, keys.low[0], "left")
        hi = np.searchsorted(self.first, keys.high[0], "right")
        for i in np.flatnonzero((hi > lo) & (keys.lengths > 8)):
            part = self.second[lo[i]: hi[i]]
            start = lo[i]
            lo[i] = start + np.searchsorted(part, keys.low[1][i], "left")
            hi[i] = start + np.searchsorted(part, keys.high[1][i], "right")
        count = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(keys.pieces)), count)
        skip = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        where = self.order[np.repeat(lo, count) + skip]
        keep = where + keys.lengths[which] <= len(self.buffer)
        for i in np.flatnonzero((keys.lengths > 16) & (count > 0)):  # beyond the sorted prefix: compare the rest
            tail = np.frombuffer(keys.pieces[i], np.uint8)[16:]
            own = np.flatnonzero((which == i) & keep)
            at = where[own][:, None] + 16 + np.arange(len(tail))
            keep[own] = (self.buffer[at] == tail).all(axis=1)
        return where[keep], which[keep]


class _Words(dict):
    """Words between single spaces, as they are written, to the number of their stretch."""

    def __init__(self, number) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> int:
        n = self[word] = self.number(MARK + word)
        return n


class Encoder:
    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.ids = np.array([i for i, p in enumerate(model.pieces) if p])
        self.keys = PieceKeys([model.pieces[i] for i in self.ids])
        self._begin()

    def _begin(self) -> None:
        self.cache: dict[str, int] = {}  # stretches met, with their number
        self.fresh: list[str] = []  # of these the ones not segmented yet
        self.words = _Words(self._number)
        self.starts, self.stored = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _number(self, stretch: str) -> int:
        i = self.cache.get(stretch)
        if i is None:
            i = self.cache[stretch] = len(self.cache)
            self.fresh.append(stretch)
        return i

    def _stretches(self, text: str) -> list[int]:
        if not text:
            return []
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            words = self.words
            return [words[w] for w in text.split(" ")]
        return [self._number(s) for s in _STRETCH.findall(MARK + text.replace(" ", MARK))]

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts)."""
        if len(self.cache) > CACHE:
            self._begin()
        rows = [self._stretches(t) for t in batch]
        if self.fresh:
            ids, ends = self._segment(self.fresh)
            self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
            self.stored = np.concatenate([self.stored, ids])
            self.fresh = []
        ids, ends = gather(self.stored, self.starts, np.fromiter(chain.from_iterable(rows), np.int64))
        return ids, np.concatenate([[0], ends])[np.cumsum([0] + [len(r) for r in rows])].astype(np.int64)

    def _segment(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches, running count of ids after each stretch)."""
        raw = [s.encode() for s in stretches]
        buffer = np.frombuffer(SEPARATOR.join([b"", *raw, b""]), np.uint8)
        n = len(buffer)
        owner_start = np.cumsum([1] + [len(r) + 1 for r in raw[:-1]])
        owner_end = owner_start + np.array([len(r) for r in raw])
        where, which = SuffixIndex(buffer).occurrences(self.keys)
        by_position = np.argsort(where, kind="stable")
        s, piece = where[by_position], which[by_position]
        e = s + self.keys.lengths[piece]
        boundary = (buffer & 0xC0) != 0x80  # the start of a character or a separator
        token = np.full(n, -1, np.int32)
        inner = np.cumsum(boundary)
        single = inner[e - 1] == inner[s]
        token[s[single]] = self.ids[piece[single]]
        s, e, piece = s[~single], e[~single], piece[~single]
        owner = np.searchsorted(owner_start, s, "right") - 1
        long = (owner_end - owner_start)[owner] > LONG
        self._contract_short(boundary, token, s[~long], e[~long], piece[~long], owner[~long])
        if long.any():
            edges = (s[long], e[long], piece[long], owner[long])
            for o in np.unique(edges[3]):
                mine = edges[3] == o
                self._contract_long(boundary, token, *(x[mine] for x in edges[:3]))
        # characters without a piece: a token per byte
        symbol = np.maximum.accumulate(np.where(boundary, np.arange(n), 0))
        bare = token[symbol] < 0
        token[bare] = self.model.byte_ids[buffer[bare]]
        is_token = (boundary | bare) & (buffer != 0xFF)
        return token[is_token], np.cumsum(is_token)[owner_end - 1]

    def _contract_short(self, boundary, token, s, e, piece, owner) -> None:
        ranks = self.model.ranks[self.ids[piece]]
        while len(s):
            live = boundary[s] & boundary[e]
            s, e, piece, owner, ranks = s[live], e[live], piece[live], owner[live], ranks[live]
            inner = np.cumsum(boundary)
            joins = inner[e - 1] - inner[s]  # boundaries strictly inside the edge
            waiting = joins > 0
            if not waiting.all():
                s, e, piece, owner, ranks, joins = (x[waiting] for x in (s, e, piece, owner, ranks, joins))
            now = np.flatnonzero(joins == 1)
            if not len(now):
                return
            own = owner[now]
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            keys = (ranks[now] << 32) | np.arange(len(now))
            best = now[np.minimum.reduceat(keys, heads) & 0xFFFFFFFF]
            marks = np.flatnonzero(boundary)
            boundary[marks[inner[s[best]]]] = False  # the one boundary after the edge's start
            token[s[best]] = self.ids[piece[best]]

    def _contract_long(self, boundary, token, s, e, piece) -> None:
        span = {(int(a), int(b)): (int(self.model.ranks[self.ids[p]]), int(self.ids[p])) for a, b, p in zip(s, e, piece)}
        lo, hi = int(s.min()), int(e.max())
        marks = [lo + int(i) for i in np.flatnonzero(boundary[lo:hi])] + [hi]
        after = dict(zip(marks, marks[1:]))
        before = dict(zip(marks[1:], marks))
        heap = []

        def offer(a: int) -> None:
            b = after.get(a)
            c = after.get(b)
            if c is not None and (a, c) in span:
                heapq.heappush(heap, (span[a, c][0], a, b, c))

        for a in marks:
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if after.get(a) != b or after.get(b) != c:
                continue
            after[a], before[c] = c, a
            del after[b], before[b]
            boundary[b] = False
            token[a] = span[a, c][1]
            if a in before:
                offer(before[a])
            offer(a)


class Decoder:
    """The bytes of each id; a space mark is a space."""

    def __init__(self, model: PieceModel) -> None:
        parts = [p.replace(MARK.encode(), b" ") for p in model.pieces]
        for value, i in enumerate(model.byte_ids):
            parts[i] = bytes([value])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of every text, without the space mark that encoding puts first."""
        data, ends = gather(self.bytes, self.starts, ids)
        at = np.concatenate([[0], ends])[offsets].tolist()
        data = data.tobytes()
        return [data[x + (data[x: x + 1] == b" " and x < y): y] for x, y in zip(at, at[1:])]


def _map_encoded(docs: DataFrame, model_file: str, columns: str, make) -> DataFrame:
    """doc_id and ids of every document, and what ``make`` (texts, decoded bytes) gives for a batch."""
    model = read_model(model_file)
    ready: list[tuple[Encoder, Decoder]] = []  # one per Python worker

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append((Encoder(model), Decoder(model)))
        encoder, decoder = ready[0]
        rows = texts(b)
        ids, offsets = encoder.encode(rows)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        more = make(rows, decoder.decode(ids, offsets))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), lists, *more.values()], ["doc_id", "ids", *more])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>, {columns}")


def encode_documents(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, ids (array), decoded (the text that the ids give back)."""
    return _map_encoded(docs, model_file, "decoded string", lambda rows, back: {
        "decoded": pa.array([x.decode(errors="replace") for x in back], pa.string())})


def encoded(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256, round_trip (the decoded text is the text)."""
    def compared(rows: list[str], back: list[bytes]) -> dict[str, pa.Array]:
        return {"decoded_sha256": pa.array([sha256(x).hexdigest() for x in back], pa.string()),
                "round_trip": pa.array([x == t.replace(MARK, " ").encode() for t, x in zip(rows, back)], pa.bool_())}

    return _map_encoded(docs, model_file, "decoded_sha256 string, round_trip boolean", compared).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256", "round_trip")


@register("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
