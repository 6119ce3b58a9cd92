r"""Sets of word shingles as sorted 64-bit hashes.

Words are lower-cased (A-Z) ``[^\x20\x09-\x0D]+``; a set holds the distinct shingles of five
words, or the whole sequence where there are fewer words, or nothing where there is none.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .mail import FOLD, chained, mixed

SHINGLE = 5
WORDS_HELD = 200_000


class ShingleSets:
    """Turns texts into sets. Keeps the hashes of words it has met, up to a bound."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > WORDS_HELD:
            self.known = {}
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def sets(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(elements, sizes): the sets one after the other, each sorted."""
        words: list[bytes] = []
        counts = []
        for t in batch:
            own = t.encode().lower().split()
            words += own
            counts.append(len(own))
        count = np.array(counts, np.int64)
        h = self._hashes(words)
        owner = np.repeat(np.arange(len(batch)), count)
        heads = np.cumsum(count) - count
        long = np.flatnonzero(owner[SHINGLE - 1:] == owner[: len(owner) - SHINGLE + 1]) if len(h) >= SHINGLE else np.zeros(0, np.int64)
        shingle = h[long]
        for i in range(1, SHINGLE):
            shingle = chained(shingle, h[long + i])
        owners = [owner[long]]
        values = [shingle]
        for i in np.flatnonzero((count > 0) & (count < SHINGLE)):
            whole = np.array([count[i]], np.uint64)  # the length starts the chain, so none equals a shingle's
            for x in h[heads[i]: heads[i] + count[i]]:
                whole = chained(whole, np.array([x]))
            owners.append(np.array([i]))
            values.append(whole)
        owner, value = np.concatenate(owners), np.concatenate(values)
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owner, value = owner[new], value[new]
        return value, np.bincount(owner, minlength=len(batch)).astype(np.int64)


def set_ids(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, the same for equal sets; 0 for the empty set."""
    ids = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(mixed(elements), starts)
        ids[full] = np.maximum(mixed(sums + sizes[full].astype(np.uint64) * FOLD), np.uint64(1))
    return ids
