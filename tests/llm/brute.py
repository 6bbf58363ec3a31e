"""Plain Python versions of the contracts, for small tables; rows are (id, text)."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs):
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i : i + 200] for _, t in raw for i in range(len(t) - 199))
    out = []
    for d, t in raw:
        edge = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                edge[i] += 1
                edge[i + 200] -= 1
        gone = np.cumsum(edge)[: len(t)] > 0
        n_spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((d, len(t), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def simhash(text):
    words = [w.encode() for w in WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(docs, bits=4):
    prints = [simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)]


def versions(docs):
    """(id, n_chars, SHA-256 of the edited text) in descending order of id."""
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, other = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        out.append((d, len(t), hashlib.sha256((t[: len(t) - k] + other[:k]).encode()).hexdigest()))
    return out


def crc_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def targets(sizes: dict, weights: list[float], total: float, most: float = 2.0) -> dict:
    """Target of each source: ``total`` by weight, none above ``most`` times its size.

    Sources are ordered by code point with the null source last; the weights repeat. What
    a full source cannot take is shared again among the others by weight.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), total
    while free:
        share = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / share > most * sizes[s]]
        if not full:
            out.update((s, left * weight[s] / share) for s in free)
            break
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out
