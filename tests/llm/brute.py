"""Plain versions of the corpus operators, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

LAST = (1 << 63) - 1


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", lower(text)) if w]


def fold(doc, folds):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % folds


def repeats(docs, length=50):
    """n_bytes, n_removed, n_spans and kept digest of each row."""
    first: dict[bytes, int] = {}
    ranked = [(LAST if d is None else d, (t or "").encode()) for d, t in docs]
    for doc, raw in ranked:
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, raw in ranked:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < doc:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size):
    w = words(text)
    if not w:
        return frozenset()
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near(docs, size=4, percent=80):
    """n_shingles, component and kept of each row; ids must be present."""
    sets = [shingles(t, size) for _, t in docs]
    label = [d for d, _ in docs]
    links = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    while True:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return [(len(s), c, c == d) for (d, _), s, c in zip(docs, sets, label)]


def language_model(docs, m, folds=7, held=2):
    """n_tokens, n_known, train_tokens, base and score of each row, by the formulas of the automaton."""
    tokens = [[*words(t), None] for _, t in docs]
    train = [t for (d, _), t in zip(docs, tokens) if fold(d, folds) != held]
    counts = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<start>", *[("w", w) for w in t]], t))
    n, v = sum(counts.values()), len(counts)
    history = lambda u: len(train) if u == "<start>" else counts[u[1]]
    p = lambda w: (counts[w] + 1) / (n + v + 1)
    out = []
    for t in tokens:
        base = sum(math.log10(p(w)) for w in t)
        score = sum(
            math.log10((pairs[u, w] + m * p(w)) / (history(u) + m)) for u, w in zip(["<start>", *[("w", w) for w in t]], t)
        )
        out.append((len(t), sum(counts[w] > 0 for w in t), n, base, score))
    return out


def raked(cells, targets, sweeps):
    """Weights of {(a, b, ...): weight} after raking to a list of {value: target}, one per place."""
    cells = dict(cells)
    for _ in range(sweeps):
        for place, target in enumerate(targets):
            sums = Counter()
            for key, weight in cells.items():
                sums[key[place]] += weight
            cells = {k: w * target[k[place]] / sums[k[place]] for k, w in cells.items()}
    return cells
