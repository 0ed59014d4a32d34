"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def statistics(text):
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    counts = [0] * 64
    for s in shingles:
        h = xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def linked_groups(values, linked):
    """Smallest number reachable for each value by pairs that are ``linked``."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def without_repeats(texts, length):
    """(bytes, removed, runs, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for i, b in enumerate(raw):
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]].append((i, p))
    cover = [bytearray(len(b)) for b in raw]
    for at in seen.values():
        if len(at) > 1:
            for i, p in at:
                cover[i][p : p + length] = b"\1" * length
    out = []
    for b, c in zip(raw, cover, strict=True):
        kept = bytes(x for x, hit in zip(b, c, strict=True) if not hit)
        runs = len(re.findall(b"\1+", bytes(c)))
        out.append((len(b), sum(c), runs, hashlib.sha256(kept).hexdigest()))
    return out


def greedy_pieces(word, vocabulary):
    count = 0
    while word:
        size = next((k for k in range(len(word), 0, -1) if word[:k] in vocabulary), None)
        if size is None:
            return None
        word, count = word[size:], count + 1
    return count
