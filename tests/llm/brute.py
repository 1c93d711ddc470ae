"""Plain versions of what the operators compute, for small inputs."""

import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def components(nodes, linked):
    """Smallest member of each node's component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def simhash(text):
    own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def line_set(line, size=10):
    line = line.strip(" \t\x0b\f\r").lower()
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def repeats(text, window=8):
    """Words in repeated windows, and the longest repeat."""
    own = words(text)
    n = len(own)
    at = {}
    for i in range(n - window + 1):
        at.setdefault(tuple(own[i : i + window]), []).append(i)
    inside = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(window)}
    longest = 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and own[i + k] == own[j + k]:
                k += 1
            longest = max(longest, k)
    return len(inside), longest


def targets(sizes, weights=(1, 2, 3), most=3):
    """Repeated resharing by weight, as one would do by hand."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in order if s not in capped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update((s, most * sizes[s]) for s in over)
