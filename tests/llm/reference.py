"""Plain, slow versions of the training-data operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def components(nodes, links):
    root = {x: x for x in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def near_texts(texts: dict, size: int) -> dict:
    sets = {k: shingles(t, size) for k, t in texts.items()}
    by = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            by[x].append(k)
    shared = Counter((a, b) for ks in by.values() for i, a in enumerate(ks) for b in ks[i + 1 :])
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    return {k: (len(sets[k]), c) for k, c in components(sets, links).items()}


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    def good(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 10 <= len(digits) <= 15

    found = sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(KINDS.items()) for m in re.finditer(p, text or "") if good(k, m[0]))
    return [f"{k}:{a}:{z}" for a, _, z, k in found]


def best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k in range(len(bins)) if bins[k] >= n]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)
