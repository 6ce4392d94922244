"""Brute-force versions of the operators' results, in plain Python."""

import hashlib
from collections import Counter, defaultdict

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text, lower=True):
    data = (text or "").encode()
    return (data.translate(ASCII_LOWER) if lower else data).split()


def shingle_set(text, k):
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(texts, k, num, den):
    """(set size, smallest linked id) of each id."""
    sets = {d: shingle_set(t, k) for d, t in texts.items()}
    holders = defaultdict(list)
    for d, s in sorted(sets.items()):
        for g in s:
            holders[g].append(d)
    common = Counter((a, b) for ds in holders.values() for i, b in enumerate(ds) for a in ds[:i])
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in common.items():
        if n * den >= num * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def without_repeats(rows, length):
    """(words, removed, hash of what stays) of each row, in order."""
    split = [words(t, lower=False) for t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                keep[i : i + length] = [False] * length
        kept = [x for x, k in zip(w, keep) if k]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out
