"""Slow plain-Python scorers, written from the definitions, to check the fast ones against."""


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 0.0


def partial_ratio(a, b):
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a

    def best(needle, hay):
        m, n = len(needle), len(hay)
        return max(ratio(needle, hay[max(0, e - m) : min(e, n)]) for e in range(1, n + m))

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


def token_sort_ratio(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _sets(a, b):
    x, y = set(a.split()), set(b.split())
    return x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set_ratio(a, b):
    if not a or not b:
        return 0.0
    both, da, db = _sets(a, b)
    if both and (not da or not db):
        return 100.0
    s = len(" ".join(both))
    g = 1 if s else 0
    p, q = s + g + len(da), s + g + len(db)
    distance = len(da) + len(db) - 2 * lcs_length(da, db)
    scores = [100.0 * (p + q - distance) / (p + q)]
    if s:
        scores.append(200.0 * s / (s + p))
        scores.append(200.0 * s / (s + q))
    return max(scores)


def weighted_ratio(a, b):
    if not a or not b:
        return 0.0
    r = max(len(a), len(b)) / min(len(a), len(b))
    base = ratio(a, b)
    if r < 1.5:
        return max(base, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    k = 0.9 if r <= 8 else 0.6
    both, da, db = _sets(a, b)
    if both:
        token = 100.0
    else:
        token = max(
            partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))),
            partial_ratio(da, db),
        )
    return max(base, k * partial_ratio(a, b), token * 0.95 * k)


def ensemble(a, b):
    return max(weighted_ratio(a, b), partial_ratio(a, b))


SCORERS = {
    "ratio": ratio,
    "partial_ratio": partial_ratio,
    "token_sort_ratio": token_sort_ratio,
    "token_set_ratio": token_set_ratio,
    "WRatio": weighted_ratio,
    "ensemble": ensemble,
}


def best_matches(scorer, lefts, rights, threshold, top_n):
    """Brute-force top matches: {left index: [(right index, score), ...]}."""
    score = SCORERS[scorer]
    out = {}
    for i, left in enumerate(lefts):
        scored = [(score(left, r), j) for j, r in enumerate(rights)]
        kept = sorted(((s, j) for s, j in scored if s >= threshold), key=lambda x: (-x[0], x[1]))
        out[i] = [(j, s) for s, j in kept[:top_n]]
    return out
