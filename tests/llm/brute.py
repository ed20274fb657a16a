"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def near(docs, size, percent=80):
    """{doc_id: (shingles, component)} of {doc_id: text}."""
    sets = {i: shingles(t, size) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in docs}


def repeats(rows, length=50):
    """(n_bytes, n_removed, n_spans, sha256 of what is left) of each (doc_id, text)."""
    first: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, x in texts:
        if i is not None:
            for p in range(len(x) - length + 1):
                w = x[p:p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, x in texts:
        mark = bytearray(len(x))
        for p in range(len(x) - length + 1 if i is not None else 0):
            if first[x[p:p + length]] < i:
                mark[p:p + length] = b"\1" * length
        left = bytes(c for c, m in zip(x, mark) if not m)
        spans = sum(m and (not p or not mark[p - 1]) for p, m in enumerate(mark))
        out.append((i, len(x), sum(mark), spans, hashlib.sha256(left).hexdigest()))
    return out


def capacity(sizes, shards):
    """Smallest largest shard over all contiguous cuts, by trying every shard end (small lists)."""
    total = [0, *accumulate(sizes)]
    best = [float("inf")] * len(total)
    best[0] = 0
    for _ in range(shards):
        best = [min(max(best[j], total[i] - total[j]) for j in range(i + 1))
                for i in range(len(total))]
    return best[-1]
