"""Plain Python versions of definitions that the operators share."""

from __future__ import annotations

import re

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def split_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_fingerprint(text):
    words = split_words(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, linked):
    """Smallest node that each node is connected with, by checking every pair."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def prose(random, n, words=("the", "of", "and", "river", "stone", "light", "under", "walk", "morning", "paper")):
    return " ".join(random.choice(words) + random.choice(("", "s", "ing", "ed")) for _ in range(n))
