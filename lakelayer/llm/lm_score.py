r"""Log probability of whole texts under a smoothed n-gram model, by a weighted backoff automaton.

Tokens: lower-cased (A-Z) words ``[^\x20\x09-\x0D]+`` and one end per text. Training texts
are those whose crc32(doc_id as text) mod 5 is not 1.

Model. p1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), and for each longer history h
p(w | h) = (c(hw) + PRIOR p(w | h')) / (c(h) + PRIOR), with h' the history without its
first token: every seen n-gram counts, none is cut off.

Scoring. A batch turns the counts of its own n-grams into a weighted backoff automaton. Its states
are the root, the start of a text and every seen n-gram shorter than the order; state h has an
arc for each word w of the batch with hw seen, which carries log10 p(w | h) and leads to the
longest seen history that ends in w, and a failure arc to h', which carries
log10(PRIOR / (c(h) + PRIOR)). The root has an arc for every word. A text is read once from left to
right: where the state has no arc for the word, failure arcs are followed, their weights added,
until one has. Texts are read side by side, and long ones in pieces: the state depends on the last
order - 1 words alone, so a piece reads these first, from the root, and then stands where
the whole text would.

Scale. No task holds the model. A batch of texts asks for the counts of its own n-grams
(``mail``), all n-grams of the corpus being counted in parts by hash; with the answers it
scores its texts. N-grams are 64-bit hashes.

Defined cases: a null or empty text is one end token; a null ``doc_id`` counts as held out;
without any training text all counts are zero; repeated rows are scored (and learned from)
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import texts
from .mail import batches_and_parts, chained, cuts, dealt, from_planes, packed, planes, unpacked
from .registry import register, table

ORDER = 2
PRIOR = 500.0
BATCHES = 3  # for each part; a batch is held in memory several times over
PIECE = 256  # tokens of a text read in one go, side by side with other pieces
HELD_REMAINDER, FOLDS = 1, 5
ROOT, BEGIN = 0, 1  # states
END, START = np.uint64(1), np.uint64(2)  # hashes of the end token and of the start of a text


class Tokens:
    """The tokens of a batch as hashes, text after text, with their n-grams."""

    def __init__(self, batch: list[str], order: int) -> None:
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        end = vocabulary[b" "]  # no word is a space
        ids: list[int] = []
        sizes = []
        for t in batch:
            words = t.encode().lower().split()  # on \x20 and \x09-\x0D, as bytes split
            ids.extend(map(vocabulary.__getitem__, words))
            ids.append(end)
            sizes.append(len(words) + 1)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
        hashes[end] = END
        self.sizes = np.array(sizes, np.int64)
        self.heads = np.cumsum(self.sizes) - self.sizes
        word = hashes[np.array(ids, np.int64)]
        place = np.arange(len(word)) - np.repeat(self.heads, self.sizes)
        #: per order: the distinct n-grams, which one ends at each token, and whether one does
        self.grams: list[np.ndarray] = []
        self.which: list[np.ndarray] = []
        self.there: list[np.ndarray] = []
        gram = word
        for k in range(1, order + 1):
            if k > 1:
                before = np.concatenate([[START], gram[:-1]])
                before[self.heads] = START
                gram = chained(before, word)
            there = place >= k - 2  # the start of a text stands for one token of history
            distinct, which = np.unique(gram[there], return_inverse=True)
            full = np.zeros(len(word), np.int32)
            full[there] = which
            self.grams.append(distinct)
            self.which.append(full)
            self.there.append(there)


class Automaton:
    """States, arcs and failure arcs over the words of a batch.

    Arcs lie sorted by ``key`` = state * words + word; ``weight`` and ``to`` answer to them. ``fail``,
    ``fail_weight`` answer to states.
    """

    def __init__(self, tokens: Tokens, counts: list[np.ndarray], n: int, v: int, prior: float) -> None:
        self.order, self.words = len(counts), len(tokens.grams[0])
        self.begin = BEGIN if self.order > 1 else ROOT
        ends = tokens.grams[0] == END
        state_counts = [np.array([0, counts[0][ends].sum()], np.int64)]
        fails = [np.array([ROOT, ROOT], np.int32)]
        states: list[np.ndarray] = []  # per order: the state of a distinct n-gram, the root where it is unseen
        size = 2
        keys, weights, to = [], [], []
        for k, count in enumerate(counts, 1):
            here = np.flatnonzero(tokens.there[k - 1])
            at = np.empty(len(count), np.int64)
            at[tokens.which[k - 1][here]] = here  # a token where the n-gram ends
            seen = np.flatnonzero(count > 0)
            if k == 1:
                arcs = np.arange(self.words)  # the root knows every word
                word, shorter, source = arcs, np.zeros(self.words, np.int32), np.zeros(self.words, np.int64)
                weight = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
            else:
                arcs, at = seen, at[seen]
                word, suffix = tokens.which[0][at], tokens.which[k - 2][at]
                shorter = states[-1][suffix]
                source = states[-1][tokens.which[k - 2][at - 1]].astype(np.int64)
                if k == 2:
                    source[np.isin(at, tokens.heads)] = BEGIN
                history = np.concatenate(state_counts)[source]
                weight = np.zeros(len(count))
                weight[arcs] = np.log10((count[arcs] + prior * 10.0 ** shorter_weight[suffix]) / (history + prior))
            if k < self.order:
                state = np.zeros(len(count), np.int32)
                state[seen] = size + np.arange(len(seen))
                size += len(seen)
                states.append(state)
                state_counts.append(count[seen])
                fails.append(shorter if k > 1 else np.zeros(len(seen), np.int32))
                target = state[arcs]
            else:
                target = shorter
            keys.append(source * self.words + word)
            weights.append(weight[arcs])
            to.append(np.where(ends[word], self.begin, target).astype(np.int32))
            shorter_weight = weight
        key = np.concatenate(keys)
        by = np.argsort(key, kind="stable")
        self.key, self.weight, self.to = key[by], np.concatenate(weights)[by], np.concatenate(to)[by]
        self.fail = np.concatenate(fails)
        self.fail_weight = np.log10(prior / (np.concatenate(state_counts) + prior))

    def arc(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The arc of each state for its word, -1 where there is none."""
        key = state.astype(np.int64) * self.words + word
        place = np.searchsorted(self.key, key)
        return np.where(self.key[np.minimum(place, len(self.key) - 1)] == key, place, -1)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every state reads its word: the states that follow, and the weights of the arcs taken."""
        state, weight, arc = state.copy(), np.zeros(len(state)), self.arc(state, word)
        left = np.flatnonzero(arc < 0)
        while len(left):
            weight[left] += self.fail_weight[state[left]]
            state[left] = self.fail[state[left]]
            arc[left] = self.arc(state[left], word[left])
            left = left[arc[left] < 0]
        return self.to[arc], weight + self.weight[arc]

    def traverse(self, tokens: Tokens, piece: int = PIECE) -> np.ndarray:
        """Log10 probability of every token, each text read from left to right."""
        words, back = tokens.which[0], self.order - 1
        piece = max(piece, back)
        pieces = -(-tokens.sizes // piece)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(np.repeat(tokens.sizes, pieces) - nth * piece, piece)
        by = np.argsort(-length, kind="stable")
        first = (np.repeat(tokens.heads, pieces) + nth * piece)[by]
        shorter_last, later = -length[by], np.flatnonzero(nth[by] > 0)
        state = np.where(nth[by] == 0, self.begin, ROOT).astype(np.int32)
        for i in range(back, 0, -1):
            state[later], _ = self.step(state[later], words[first[later] - i])
        out = np.empty(len(words))
        for i in range(-shorter_last[0] if len(by) else 0):
            reading = np.searchsorted(shorter_last, -i)  # pieces longer than i
            at = first[:reading] + i
            state[:reading], out[at] = self.step(state[:reading], words[at])
        return out


def score_documents(docs: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    spark = docs.sparkSession
    parts = batches_and_parts(spark)
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = dealt(docs, BATCHES * parts, F.coalesce(remainder == HELD_REMAINDER, F.lit(True)).alias("held_out"))
    names = [f"g{k}" for k in range(order)]

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        tokens = Tokens(texts(group), order)
        learned = np.repeat(~group.column("held_out").to_numpy(), tokens.sizes)
        columns = {"batch": pa.array([key[0].as_py()] * parts, pa.int32()), "part": pa.array(range(parts), pa.int32())}
        for name, grams, which, there in zip(names, tokens.grams, tokens.which, tokens.there):
            counts = np.bincount(which[learned & there], minlength=len(grams)).astype(np.int32)
            at = cuts(grams, parts)
            columns[name] = pa.array([planes(grams[a:b]) for a, b in zip(at, at[1:])], pa.binary())
            columns[name + "_n"] = packed([counts[a:b] for a, b in zip(at, at[1:])])
        return pa.table(columns)

    def answer(key: tuple, group: pa.Table) -> pa.Table:
        columns = {"batch": group.column("batch"), "part": group.column("part")}
        for name in names:
            asked = [from_planes(b, np.uint64) for b in group.column(name).to_pylist()]
            distinct, which = np.unique(np.concatenate(asked), return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, which, np.concatenate(unpacked(group, name + "_n", np.int32)))
            ends = np.cumsum([len(a) for a in asked])[:-1]
            columns[name] = packed(np.split(total[which], ends))
            if name == names[0]:
                columns["n"] = pa.array([int(total.sum())] * len(asked), pa.int64())
                columns["v"] = pa.array([int((total > 0).sum())] * len(asked), pa.int64())
        return pa.table(columns)

    def score(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        tokens = Tokens(texts(group), order)
        replies = replies.sort_by("part")
        counts = [np.concatenate([np.zeros(0, np.int64), *unpacked(replies, name, np.int64)]) for name in names]
        if [len(c) for c in counts] != [len(g) for g in tokens.grams]:
            raise RuntimeError("the documents changed while they were being scored")
        n, v = (sum(replies.column(c).to_pylist()) for c in ("n", "v"))
        root = np.log10((counts[0] + 0.5) / (n + 0.5 * (v + 1)))[tokens.which[0]]
        per_text = lambda x: np.add.reduceat(x, tokens.heads) if len(x) else x
        return pa.table({
            "doc_id": group.column("doc_id"), "held_out": group.column("held_out"),
            "n_tokens": tokens.sizes, "n_known": per_text((counts[0] > 0).astype(np.int64)[tokens.which[0]]),
            "train_tokens": np.full(len(tokens.sizes), n, np.int64),
            "base_score": per_text(root),
            "score": per_text(Automaton(tokens, counts, n, v, prior).traverse(tokens))})

    pair = lambda suffix: ", ".join(f"{x} binary{suffix and f', {x}{suffix} binary'}" for x in names)
    asked = rows.groupBy("batch").applyInArrow(ask, f"batch int, part int, {pair('_n')}")
    replies = asked.groupBy("part").applyInArrow(answer, f"batch int, part int, {pair('')}, n bigint, v bigint")
    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        score, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens bigint, n_known bigint, "
               "train_tokens bigint, base_score double, score double")


@register("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
