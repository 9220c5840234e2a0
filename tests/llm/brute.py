"""Plain definitions of the operators' results, for small tables."""

import hashlib
import re
from collections import defaultdict

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeats(docs, window):
    """[(doc_id, text)] -> [(doc_id, n_words, n_removed, kept_sha256)]"""
    seen = defaultdict(int)
    split = [SPACES.findall(t or "") for _, t in docs]
    for w in split:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = []
    for (doc_id, _), w in zip(docs, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def byte_repeats(docs, size):
    """[(doc_id, text)] -> [(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]"""
    first = {}
    data = [(d, (t or "").encode()) for d, t in docs]
    for d, b in data:
        for i in range(len(b) - size + 1):
            x = b[i : i + size]
            first[x] = min(first.get(x, d), d)
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\x01" * size
        out.append((d, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, n):
    w = SPACES.findall((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def ngram_components(docs, n=4, p=85, q=100):
    """[(doc_id, text)] -> {doc_id: (n_shingles, component_id)}"""
    sets = {d: shingles(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets, key=lambda d: len(sets[d]))
    for i, a in enumerate(ids):
        x = sets[a]
        for b in ids[i + 1 :]:
            y = sets[b]
            if len(y) * p > len(x) * q:
                break
            if not x:
                continue
            common = len(x & y)
            if q * common >= p * (len(x) + len(y) - common):
                r, s = find(a), find(b)
                parent[max(r, s)] = min(r, s)
    return {d: (len(sets[d]), find(d)) for d in sets}


LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, window):
    """-> [(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]"""
    phrases = defaultdict(set)
    for item, text in items:
        w = LETTERS.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - window, 0) + 1) if w else ():
            phrases[tuple(w[i : i + window])].add(str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for d, text in docs:
        w = LETTERS.findall((text or "").translate(LOWER))
        hit, own = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i : i + k])) in phrases:
                    hit.update(range(i, i + k))
                    own |= phrases[x]
        out.append((d, len(w), len(hit), len(own), sha(",".join(sorted(own))), bool(hit)))
    return out


def window_counts(docs, window):
    seen = defaultdict(int)
    for _, t in docs:
        w = SPACES.findall(t or "")
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    return seen


def cut(text, spans, gone):
    """The text without the runs of removed words."""
    out, at, i = [], 0, 0
    while i < len(spans):
        if i in gone:
            out.append(text[at : spans[i][0]])
            while i < len(spans) and i in gone:
                at = spans[i][1]
                i += 1
        else:
            i += 1
    return "".join(out) + text[at:]


def without_repeats(text, seen, window):
    found = list(SPACES.finditer(text or ""))
    gone = set()
    for i in range(len(found) - window + 1):
        if seen[tuple(m.group() for m in found[i : i + window])] > 1:
            gone.update(range(i, i + window))
    return cut(text or "", [m.span() for m in found], gone)


def without_leaks(text, items, window):
    phrases = set()
    for _, t in items:
        w = LETTERS.findall((t or "").translate(LOWER))
        for i in range(max(len(w) - window, 0) + 1) if w else ():
            phrases.add(tuple(w[i : i + window]))
    found = list(LETTERS.finditer(text.translate(LOWER)))
    gone = set()
    for k in {len(p) for p in phrases}:
        for i in range(len(found) - k + 1):
            if tuple(m.group() for m in found[i : i + k]) in phrases:
                gone.update(range(i, i + k))
    return cut(text, [m.span() for m in found], gone)
