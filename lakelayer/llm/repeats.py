"""Repeated byte strings: anchors of windows, and the enhanced suffix array of their contexts.

A window is a string of ``LENGTH`` bytes. Its anchor is the leftmost of its ``GRAM``-byte
strings with the least hash; equal windows have equal anchors at equal places, so equal
windows meet when anchors meet by hash. Neighbouring windows mostly share their anchor;
such a run, with the bytes of its windows, is a context.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .mail import FOLD, mixed

LENGTH = 50
GRAM = 32
STEPS = LENGTH - GRAM + 1  # grams of a window, and windows of a run at most
WIDTH = LENGTH + STEPS - 1  # bytes of a context at most
PIECE = 1 << 20  # bytes looked at together


@dataclass
class Runs:
    """Windows first .. last of a text share the anchor with this hash."""

    hashes: np.ndarray
    owner: np.ndarray  # index of the text
    first: np.ndarray  # byte position in the text
    last: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)

    def take(self, index: np.ndarray) -> Runs:
        return Runs(self.hashes[index], self.owner[index], self.first[index], self.last[index])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    word = data.astype(np.uint64)
    for width in (1, 2, 4):
        word = word[:-width] | word[width:] << np.uint64(8 * width)
    n = len(data) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for at in range(0, GRAM, 8):
        out = (out ^ word[at: at + n]) * FOLD
        out ^= out >> np.uint64(29)
    return mixed(out)


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the position of the leftmost least value of values[i : i + width]."""
    least, where, done = values, np.arange(len(values), dtype=np.int32), 1
    while done < width:
        step = min(done, width - done)
        left, right = least[:-step], least[step:]
        take = right < left
        where = np.where(take, where[step:], where[:-step])
        least = np.where(take, right, left)
        done += step
    return where


def _piece_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, first, last) of the runs; ``ends``: for each window start, where its text ends."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = _gram_hashes(data)
    anchor = _leftmost_least(hashes, STEPS)
    windows = np.flatnonzero(np.arange(LENGTH, LENGTH + n) <= ends[:n])
    anchor = anchor[windows]
    if not len(windows):
        return np.zeros(0, np.uint64), windows, windows
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(windows)) - 1
    # least hashes lie low; hashed again they spread evenly over the parts
    return mixed(hashes[anchor[heads]] + FOLD), windows[heads], windows[tails]


def find_runs(texts: list[bytes]) -> Runs:
    """The runs of all texts, in order of text and position."""
    out: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []  # text index, offset in the text, bytes

    def flush() -> None:
        if not held:
            return
        sizes = np.array([len(b) for _, _, b in held])
        stops = np.cumsum(sizes)
        data = np.frombuffer(b"".join(b for _, _, b in held), np.uint8)
        hashes, first, last = _piece_runs(data, np.repeat(stops, sizes))
        piece = np.searchsorted(stops, first, "right")
        offset = np.array([o for _, o, _ in held]) - (stops - sizes)
        out.append((hashes, np.array([i for i, _, _ in held])[piece], first + offset[piece], last + offset[piece]))
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        for at in range(0, len(t) - LENGTH + 1, PIECE):  # a long text in pieces that share LENGTH - 1 bytes
            held.append((i, at, t[at: at + PIECE + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= PIECE:
                flush()
                size = 0
    flush()
    if not out:
        none = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), none, none, none)
    return Runs(*(np.concatenate(x) for x in zip(*out)))


@dataclass
class Groups:
    """Maximal repeats: a string of ``length`` bytes, at ``members[start : start + size]``."""

    length: np.ndarray
    start: np.ndarray
    size: np.ndarray
    members: np.ndarray  # suffix index: context * STEPS + offset


class ContextIndex:
    """Enhanced suffix array over the window suffixes of distinct contexts.

    ``bodies``: contexts as rows of WIDTH bytes, zero-padded; ``sizes``: their bytes. The
    suffixes are those that begin a window. They are sorted by their bytes; ``common`` is the
    length of the prefix that a suffix shares with the one before.
    """

    def __init__(self, bodies: np.ndarray, sizes: np.ndarray) -> None:
        self.bodies, self.sizes = bodies, sizes
        n = len(bodies)
        windows = sizes - LENGTH + 1
        context = np.repeat(np.arange(n), windows)
        offset = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
        padded = np.zeros((n, WIDTH + WIDTH + 8), np.uint8)
        padded[:, :WIDTH] = bodies
        flat, row = padded.ravel(), padded.shape[1]
        at = context * row + offset
        words = []
        for w in range(0, WIDTH, 8):
            word = np.zeros(len(at), np.uint64)
            for b in range(8):
                word = word << np.uint64(8) | flat[at + w + b]
            words.append(word)
        order = np.lexsort(words[::-1])
        self.context, self.offset = context[order], offset[order]
        self.left_over = self.sizes[self.context] - self.offset  # bytes of the suffix
        #: shared prefix with the suffix before, counted in whole suffix bytes
        self.common = np.zeros(len(order), np.int64)
        if len(order):
            same = np.zeros(len(order) - 1, np.int64)
            open_ = np.ones(len(order) - 1, bool)
            for word in words:
                x = word[order]
                differ = x[1:] ^ x[:-1]
                equal = np.zeros(len(differ), np.int64)
                for b in range(8):  # leading bytes that agree
                    equal += differ < np.uint64(1 << 8 * b)
                same += np.where(open_, equal, 0)
                open_ &= differ == 0
            self.common[1:] = np.minimum(same, np.minimum(self.left_over[1:], self.left_over[:-1]))
        before = np.where(self.offset > 0, flat[self.context * row + np.maximum(self.offset - 1, 0)].astype(np.int64), 0)
        #: the byte before the suffix; unknown before a context, so never equal to another
        self.before = np.where(self.offset > 0, before, 256 + np.arange(len(order)))

    def maximal_repeats(self) -> Groups:
        """The intervals of the common-prefix tree, of LENGTH bytes or more, whose occurrences differ
        in the byte before (others are extended to the left by another interval).

        The scan closes intervals by falling common prefix, one tree level at a time over the
        whole array: at level l the open intervals are the stretches with common >= l, and those
        that hold a common prefix of exactly l are nodes.
        """
        turns = np.concatenate([[0], np.cumsum(self.before[1:] != self.before[:-1])]) if len(self.before) else self.before
        length, start, size = [], [], []
        inside = np.flatnonzero(self.common >= LENGTH)
        common = self.common[inside]
        for level in range(LENGTH, int(common.max(initial=0)) + 1):
            at = inside[common >= level]
            exact = common[common >= level] == level
            if not len(at):
                break
            heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
            node = np.logical_or.reduceat(exact, heads)
            first = at[heads] - 1
            last = at[np.append(heads[1:], len(at)) - 1]
            diverse = node & (turns[last] > turns[first])
            length.append(np.full(int(diverse.sum()), level))
            start.append(first[diverse])
            size.append((last - first + 1)[diverse])
        none = np.zeros(0, np.int64)
        return Groups(*(np.concatenate([none, *x]) for x in (length, start, size)),
                      members=self.context * STEPS + self.offset)


def repeated_windows(index: ContextIndex, groups: Groups, least: np.ndarray) -> np.ndarray:
    """Per context, a bit for each window that also begins in a text with a smaller rank.

    ``least``: the smallest rank of a text with this context; a text with a larger one
    repeats every window of the context.
    """
    out = np.zeros(len(index.sizes), np.uint32)
    if not len(groups.start):
        return out
    rank = least[index.context]
    bounds = np.stack([groups.start, groups.start + groups.size], axis=1).ravel()
    lowest = np.minimum.reduceat(np.append(rank, rank[-1:]), bounds)[::2]
    which = np.repeat(np.arange(len(groups.start)), groups.size)
    at = groups.start[which] + np.arange(len(which)) - np.repeat(np.cumsum(groups.size) - groups.size, groups.size)
    later = rank[at] > lowest[which]
    at, which = at[later], which[later]
    # the repeat covers its windows: offset .. offset + length - LENGTH of the context
    run = groups.length[which] - LENGTH + 1
    bits = ((np.uint64(1) << run.astype(np.uint64)) - np.uint64(1)) << index.offset[at].astype(np.uint64)
    np.bitwise_or.at(out, index.context[at], bits.astype(np.uint32))
    return out
