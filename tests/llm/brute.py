"""Slow, literal models that the operators are held against."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(docs, k, percent):
    """docs: id -> text. id -> (set size, component)."""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    edges = set()
    for i, s in sets.items():
        hits = defaultdict(int)
        for x in s:
            for j in lists[x]:
                if j > i:
                    hits[j] += 1
        edges |= {(i, j) for j, n in hits.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)}
    comp = components(docs, edges)
    return {i: (len(sets[i]), comp[i]) for i in docs}


def repeated_bytes(texts, span):
    """texts: list of bytes. For each, a list of flags: byte covered by a window that starts at two places or more."""
    count = defaultdict(int)
    for t in texts:
        for i in range(len(t) - span + 1):
            count[t[i : i + span]] += 1
    out = []
    for t in texts:
        flags = [False] * len(t)
        until = 0
        for i in range(len(t)):
            if i + span <= len(t) and count[t[i : i + span]] > 1:
                until = i + span
            flags[i] = i < until
        out.append(flags)
    return out
