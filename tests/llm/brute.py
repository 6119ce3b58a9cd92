"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import groupby

_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def words(t):
    return (t or "").encode().lower().split()


def shingle_set(t):
    w = words(t)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs):
    """doc_id -> (set size, smallest linked id), over all pairs."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    low, high = sorted((find(a), find(b)))
                    parent[high] = low
    return {d: (len(sets[d]), find(d)) for d in ids}


def remove_repeats(docs):
    """doc_id -> (bytes, removed, runs, sha256 of what is left)."""
    least, out = {}, {}
    for d, text in sorted(docs):
        t = (text or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if least.setdefault(t[i:i + 50], d) < d:
                gone[i:i + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), sum(k for k, _ in groupby(gone)), hashlib.sha256(left).hexdigest())
    return out


def lm_scores(docs, order, prior):
    """doc_id -> (held out, tokens, known, training tokens, base score, score)."""
    tokens = lambda t: [*words(t), None]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    counts, learned = Counter(), 0
    for d, t in docs:
        if not held[d]:
            learned += 1
            w = ["start", *tokens(t)]
            for k in range(1, order + 1):
                counts.update(tuple(w[i - k + 1:i + 1]) for i in range(max(1, k - 1), len(w)))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1}
    n, v = sum(single.values()), len(single)
    counts["start",] = learned
    out = {}
    for d, t in docs:
        w = ["start", *tokens(t)]
        base = score = 0.0
        for i in range(1, len(w)):
            p = (counts[(w[i],)] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            for k in range(2, min(order, i + 1) + 1):
                p = (counts[tuple(w[i - k + 1:i + 1])] + prior * p) / (counts[tuple(w[i - k + 1:i])] + prior)
            score += math.log10(p)
        out[d] = (held[d], len(w) - 1, sum(counts[(x,)] > 0 for x in w[1:]), n, base, score)
    return out


def leaks(docs, items):
    """(doc_id, item_id) -> best similarity over all item-sized windows, where 0.8 or more."""
    shingles = lambda w: Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    known = {i: (words(t), shingles(words(t))) for i, t in items if words(t)}
    out = {}
    for d, t in docs:
        w = words(t)
        own = set(shingles(w)) if w else set()
        for i, (iw, ic) in known.items():
            if not own & set(ic) and len(iw) >= 5 and len(w) >= len(iw):
                continue  # no shingle in common
            n = len(iw)
            for a in range(max(1, len(w) - n + 1)) if w else ():
                c = shingles(w[a:a + n])
                both = sum((c & ic).values())
                s = both / (sum(c.values()) + sum(ic.values()) - both)
                if s >= 0.8:
                    out[d, i] = max(s, out.get((d, i), 0))
    return out
