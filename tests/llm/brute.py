"""Plain single-process versions of the operators, to compare with."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def lowered(text):
    return (text or "").translate(_UPPER)


def solid_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contamination(docs, items, window=13):
    """docs: (id, text); items: (id, text) -> {id: (n_words, n_hit, items)}"""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    by_size = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = re.findall(pattern, lowered(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            by_size[size][tuple(words[i : i + size])].add(name)
    out = {}
    for name, text in docs:
        words = re.findall(pattern, lowered(text))
        hit, found = set(), set()
        for size, windows in by_size.items():
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i : i + size]))
                if owners:
                    hit.update(range(i, i + size))
                    found |= owners
        out[name] = (len(words), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def repeated_words(docs, window=50):
    """{id: (n_words, kept words)} after removal of windows that start in a document of smaller id."""
    words = {name: solid_words(text) for name, text in docs}
    first = {}
    for name in sorted(words):
        w = words[name]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), name)
    out = {}
    for name, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < name:
                gone.update(range(i, i + window))
        out[name] = (len(w), [x for i, x in enumerate(w) if i not in gone])
    return out


def repeated_bytes(docs, window=100):
    """{id: (n_bytes, removed places)}: bytes under a string that also starts earlier."""
    seen, out = set(), {}
    for name, text in sorted(docs):
        data = (text or "").encode()
        gone = set()
        for i in range(len(data) - window + 1):
            piece = data[i : i + window]
            if piece in seen:
                gone.update(range(i, i + window))
            seen.add(piece)
        out[name] = (data, gone)
    return out


def shingles(text, k=5):
    w = solid_words(lowered(text))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(docs, k=5):
    """{id: (n_shingles, smallest id reachable by links)}"""
    sets = {name: shingles(text, k) for name, text in docs}
    parent = {name: name for name in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for name, s in sets.items():
        for shingle in s:
            holders[shingle].append(name)
    shared = Counter()
    for names in holders.values():
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {name: (len(s), root(name)) for name, s in sets.items()}


def quality_counts(text):
    words = solid_words(text)
    lines, repeated = set(), 0
    for line in (text or "").split("\n"):
        if solid_words(line):
            repeated += line in lines
            lines.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        repeated,
        len(inside),
    )


def runs(words, least, exponent):
    """(start, length, period) of maximal stretches of smallest period q, as long as ``least`` and ``exponent * q``."""
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, exponent * q) and smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def smallest_period(words):
    border = [0] * len(words)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def ranked(docs, items, k):
    """(item, rank, doc, score) of the k best documents of each item."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    bags = [(name, Counter(re.findall(pattern, lowered(text)))) for name, text in docs]
    bags = [(name, bag) for name, bag in bags if bag]
    total, terms = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        asked = Counter(re.findall(pattern, lowered(text)))
        scored = []
        for name, bag in bags:
            m = 75 + (25 * sum(bag.values()) * total) // terms
            score = sum(
                times * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t, times in asked.items()
                if t in bag
            )
            if score > 0:
                scored.append((-score, name))
        out += [(item, rank, name, -score) for rank, (score, name) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def nearest(rows, k, every=50):
    """(query, rank, id, score) of the k highest whole inner products."""
    whole = [(name, [math.floor(256 * float(x)) for x in v]) for name, v, *_ in rows]
    out = []
    for name, v in whole:
        if name % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), other) for other, w in whole if other != name)
            out += [(name, rank, other, -score) for rank, (score, other) in enumerate(scored[:k], 1)]
    return sorted(out)
