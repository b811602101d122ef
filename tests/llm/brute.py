"""Slow, plain versions of the operators, for comparison."""

import re

import xxhash


def simhash_fp(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    if len(words) < shingle:
        grams = [" ".join(words)]
    else:
        grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


def repeats_removed(texts, length):
    """(n_bytes, n_removed, n_spans, kept bytes) for each text."""
    from collections import Counter
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, bytes(c for c, g in zip(r, gone, strict=True) if not g)))
    return out
