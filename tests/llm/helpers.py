"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import re

import numpy as np
import xxhash


def reachable(ids, links):
    """The smallest id that each one reaches."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_fingerprint(text, width=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_links(vectors, least=0.93):
    """Pairs of (id, label, vector) rows that link."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, dtype=float)
        return v / np.linalg.norm(v)

    rows = [(i, label, unit(v)) for i, label, v in vectors]
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    return [
        (a[0], b[0])
        for n, a in enumerate(rows)
        for b in rows[n + 1 :]
        if a[1] == b[1] and len(a[2]) == len(b[2]) and float(a[2] @ b[2]) >= least
    ]
