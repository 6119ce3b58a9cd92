r"""PartEnum signatures of shingle sets.

Two sets of sizes s <= t reach Jaccard similarity 4/5 exactly when they differ in at most
(s + t) / 9 elements. Sizes fall into bands; a pair belongs to the band of its larger set,
so a set signs in its own band and in each later band that a similar set can lie in. In a
band whose largest size is r, similar sets differ in at most k = 2r / 9 elements. The
hash range of the features is cut into partitions:

* k <= 4: ``k + spare`` partitions, and a signature for every choice of all but k of them;
  the k or fewer differing elements spoil at most k partitions, so one choice is shared.
* otherwise: more than k partitions, each a signature of its own (two-level PartEnum with
  no tolerance inside a partition); at least ``partitions - k`` of them are equal.

A signature of no element at all says nothing and would be shared by many sets. It is
left out when the set has more partitions with elements than can be spoiled; otherwise
the set keeps it. ``need`` is the number of signatures that a similar set surely shares
with this one: a set with fewer shared signatures has no similar one, and up to
``need - 1`` signatures may be left out without losing a pair.

The low byte of a signature is the number of its band.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from .mail import mixed

RATIO = 1.5
SPREAD = 1.5  # partitions for each difference allowed
ENUMERATED = 4
SPARE = (1, 2, 3, 3, 3)


def band_starts(largest: int) -> list[int]:
    """The least size of each band, up to the first beyond ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return out


class Band:
    def __init__(self, number: int, low: int, next_low: int) -> None:
        self.number, self.low = number, low
        self.k = k = 2 * (next_low - 1) // 9
        if k <= ENUMERATED:
            self.partitions = k + SPARE[k]
            self.choices = list(combinations(range(self.partitions), self.partitions - k))
        else:
            self.partitions = int(SPREAD * (k + 1)) + 1
            self.choices = None
        self.seed = np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


class Bands:
    def __init__(self, largest: int) -> None:
        lows = band_starts(largest)
        # one band beyond, for the sets that also sign there
        lows.append(max(lows[-1] + 1, int(lows[-1] * RATIO)))
        self.lows = np.array(lows)
        self.bands = [Band(i, a, b) for i, (a, b) in enumerate(zip(lows, lows[1:]))]

    def signing(self, sizes: np.ndarray) -> list[tuple[Band, np.ndarray]]:
        """Per band, the indices of the sets that sign in it."""
        own = np.searchsorted(self.lows, sizes, "right") - 1
        out = []
        for b in self.bands:
            # a larger set t of this band with 4/5 t <= s
            reach = (own == b.number) | (own < b.number) & (5 * sizes >= 4 * b.low) & (sizes > 0)
            if len(index := np.flatnonzero(reach & (sizes > 0))):
                out.append((b, index))
        return out


def sign(band: Band, elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of sets given as sorted distinct hashes, set after set.

    Returns (signature, set index of each signature, need of each set).
    """
    n, m = len(sizes), band.partitions
    owner = np.repeat(np.arange(n), sizes)
    cell = ((elements >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    flat = owner * m + cell.astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    sums = np.add.reduceat(mixed(elements), heads) if len(heads) else np.zeros(0, np.uint64)
    filled = flat[heads]
    if band.choices is None:
        empty = m - np.bincount(filled // m, minlength=n)
        need = (m - band.k) - empty  # equal partitions that are surely left among those with elements
        lost = np.flatnonzero(need <= 0)  # these keep their empty partitions
        need[lost] = 1  # a similar set that is not lost leaves its empty partitions out: they share its need at least
        keys = [filled]
        values = [sums]
        if len(lost):
            grid = (lost[:, None] * m + np.arange(m)).ravel()
            grid = np.setdiff1d(grid, filled, assume_unique=True)
            keys.append(grid)
            values.append(np.zeros(len(grid), np.uint64))
        key, value = np.concatenate(keys), np.concatenate(values)
        partition = key % m
        return _tagged(mixed(value ^ mixed(band.seed + partition.astype(np.uint64))), band), key // m, need
    grid = np.zeros((n, m), np.uint64)
    grid.ravel()[filled] = sums
    weights = mixed(band.seed + np.arange(m, dtype=np.uint64)) | np.uint64(1)
    spread = mixed(grid + weights) * weights
    signatures = np.stack([spread[:, list(c)].sum(axis=1, dtype=np.uint64) + mixed(weights[:1] + np.uint64(i))
                           for i, c in enumerate(band.choices)], axis=1)
    choices = signatures.shape[1]
    # every choice may be the only shared one, so none may be left out
    return _tagged(mixed(signatures.ravel()), band), np.repeat(np.arange(n), choices), np.ones(n, np.int64)


def _tagged(signatures: np.ndarray, band: Band) -> np.ndarray:
    return signatures & ~np.uint64(0xFF) | np.uint64(band.number)
