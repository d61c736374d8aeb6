"""The operators' results by the plainest means, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import xxhash


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def repeated_bytes(rows, length: int):
    """(id, text) rows: bytes, removed, spans and what is left of each."""
    first: dict[bytes, float] = {}
    for i, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            key = data[s : s + length]
            first[key] = min(first.get(key, np.inf), np.inf if i is None else i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if first[data[s : s + length]] < (np.inf if i is None else i):
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(data), sum(gone), spans, kept))
    return out


def repeated_words(rows, length: int):
    count = collections.Counter()
    split = [(i, words(text)) for i, text in rows]
    for _, w in split:
        count.update(tuple(w[s : s + length]) for s in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if count[tuple(w[s : s + length])] > 1:
                gone[s : s + length] = [True] * length
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def fingerprint(text: str | None) -> int:
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n: int, links) -> list[int]:
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def classes(fps, distance: int = 4) -> list[int]:
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= distance]
    return components(len(fps), links)


def near_duplicates(rows, distance: int = 4):
    fps = [fingerprint(t) for _, t in rows]
    label = classes(fps, distance)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(i, f, least.get(c)) for (i, _), f, c in zip(rows, fps, label)]


def usable(vector) -> bool:
    return bool(vector) and all(v is not None and np.isfinite(v) for v in vector) and any(v != 0 for v in vector)


def linked_vectors(rows, cosine: float = 0.93):
    """(id, vector, label) rows: links, component and whether it is its component's smallest."""
    links = []
    for a, (_, x, p) in enumerate(rows):
        for b, (_, y, q) in enumerate(rows[:a]):
            if p is None or p != q or not usable(x) or not usable(y) or len(x) != len(y):
                continue
            x64, y64 = np.array(x, float), np.array(y, float)
            if x64 @ y64 / np.sqrt((x64 @ x64) * (y64 @ y64)) >= cosine - 1e-15:
                links.append((a, b))
    degree = collections.Counter(k for link in links for k in link)
    label = components(len(rows), links)
    least = {}
    for (i, _, _), c in zip(rows, label):
        least[c] = min(least.get(c, i), i)
    return [(i, degree[k], least[c], i == least[c]) for k, ((i, _, _), c) in enumerate(zip(rows, label))]
