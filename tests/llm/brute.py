"""Slow, plain versions of the operators for small fixtures."""

import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(ws, k):
    return [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else [tuple(ws)] if ws else []


def jaccard_groups(docs, k=5, percent=75):
    sets = [(d, set(shingles(words(fold(t)), k))) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((d, len(s), find(d)) for d, s in sets)


def passages(docs, k=13):
    first = {}
    for d, t in docs:
        ws = words(t)
        for i in range(len(ws) - k + 1):
            key = tuple(ws[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        ws = words(t)
        gone = set()
        for i in range(len(ws) - k + 1):
            if first[tuple(ws[i : i + k])] < d:
                gone.update(range(i, i + k))
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out)


def leaks(docs, items, k=5, threshold=0.75):
    out = set()
    for d, t in docs:
        ws = words((t or "").lower())
        for item, u in items:
            us = words((u or "").lower())
            if not us or not ws:
                continue
            size = min(k, len(us))
            want = Counter(shingles(us, size))
            if not want.keys() & set(shingles(ws, size)):
                continue  # no window shares a shingle
            for i in range(max(1, len(ws) - len(us) + 1)):
                part = ws[i : i + len(us)]
                got = Counter(shingles(part, size)) if len(part) >= size else Counter()
                both = sum((got & want).values())
                if both and both / sum((got | want).values()) >= threshold:
                    out.add((d, item))
    return out


def patience(a, b):
    """Aligned (i, j) pairs by plain recursion with a quadratic longest increasing run; of equal ones the last."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in patience(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return patience(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    ca, cb = Counter(a), Counter(b)
    anchors = [(i, b.index(x)) for i, x in enumerate(a) if ca[x] == 1 and cb[x] == 1]
    best = []
    for i, j in anchors:
        before = [best[m] for m in range(len(best)) if anchors[m][1] < j]
        best.append(max(reversed(before), key=len, default=[]) + [(i, j)])
    run = max(reversed(best), key=len, default=[])
    if not run:
        return []
    out, i0, j0 = [], 0, 0
    for i, j in [*run, (len(a), len(b))]:
        out += [(x + i0, y + j0) for x, y in patience(a[i0:i], b[j0:j])] + ([(i, j)] if i < len(a) else [])
        i0, j0 = i + 1, j + 1
    return out


def line_dedup(docs, min_words=3):
    """Alignment with every earlier document that shares a line of at least min_words words."""
    lines = {d: [x for x in (t or "").split("\n") if words(x)] for d, t in docs}
    marks = {d: {x for x in own if len(words(x)) >= min_words} for d, own in lines.items()}
    out = []
    for d, t in docs:
        gone = {i for e in lines if e < d and marks[e] & marks[d] for i, _ in patience(lines[d], lines[e])}
        n, kept = 0, []
        for x in (t or "").split("\n"):
            if not words(x) or n not in gone:
                kept.append(x)
            n += bool(words(x))
        out.append((d, len(lines[d]), len(gone), None if t is None else "\n".join(kept)))
    return sorted(out)
