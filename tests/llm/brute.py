"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import math

import numpy as np
import xxhash

FACTOR, MODULUS = 2862933555777941757, 1 << 64


def jump(key: int, shards: int) -> int:
    at, to, key = -1, 0, key % MODULUS
    while to < shards:
        at = to
        key = (key * FACTOR + 1) % MODULUS
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def cell(key: int, cells: int) -> int:
    return (key % MODULUS * FACTOR % MODULUS >> 32) % cells


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(links, nodes) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_components(texts: dict[int, str]) -> dict[int, int]:
    ids = sorted(texts)
    values = np.array([fingerprint(texts[i]) for i in ids], np.uint64)
    links = [
        (i, ids[j])
        for k, i in enumerate(ids)
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 4)
    ]
    return components(links, ids)


def mix(rows: list[tuple]) -> list[tuple]:
    """(doc_id, source, size) to (doc_id, size, source_size, target, taken, offset, tilt)."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    tilt = {s: (-0.5, 0.0, 0.5)[i % 3] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: 3.0 * total[s] for s in capped} | {
            s: left * weight[s] / sum(weight[f] for f in free) for s in free
        }
        over = {s for s in free if target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    out = []
    for s in names:
        before, quota = 0, math.floor(target[s] + 0.5)
        own = [r for r in rows if r[1] == s]
        for doc_id, _, size in sorted(own, key=lambda r: (cell(r[0] or 0, 4096), r[0] is not None, r[0] or 0, r[2])):
            taken = 0
            if total[s]:
                taken = quota // total[s] * size + max(0, min(size, quota % total[s] - before))
            out.append((doc_id, size, total[s], target[s], taken, before, tilt[s]))
            before += size
    return out


def line_components(lines: list[str], size: int = 8, similar: float = 0.8) -> dict[str, str]:
    sets = [frozenset(t[k : k + size] for k in range(max(1, len(t) - size + 1))) for t in lines]
    links = [
        (lines[i], lines[j])
        for i in range(len(lines))
        for j in range(i)
        if len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j])
    ]
    return components(links, lines)
