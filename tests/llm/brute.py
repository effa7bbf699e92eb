"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(UPPER)


def shingles(text, k):
    ws = SPACE.findall(low(text))
    if not ws:
        return set()
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))}


def linked(a, b, percent):
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def near(docs, k, percent):
    """[(id, n_shingles, component_id)] for [(id, text)]."""
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                root[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            lowest[find(i)] = min(d, lowest.get(find(i), d))
    return [(d, len(sets[i]), lowest.get(find(i))) for i, (d, _) in enumerate(docs)]


def windows(items, size=10):
    out = {}
    for item, text in items:
        ws = ALNUM.findall(low(text))
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            out.setdefault(tuple(ws[i : i + size]), set()).add(None if item is None else str(item))
    return out


def hits(text, wins):
    """(n_words, n_hit, sorted items)."""
    ws = ALNUM.findall(low(text))
    hit, items = set(), set()
    for k in {len(w) for w in wins}:
        for i in range(len(ws) - k + 1):
            found = wins.get(tuple(ws[i : i + k]))
            if found is not None:
                hit.update(range(i, i + k))
                items |= found - {None}
    return len(ws), len(hit), sorted(items)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    out = []
    for order, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and luhn(digits),
                    "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), order, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]
