"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def near_duplicates(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(k)
    for k, (i, s) in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j < k)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return Counter((i, len(s), find(i), find(i) == i) for i, s in sets)


def line_dedup(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first, docs = {}, defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(k := key(line)) >= 10:
                first[k] = min(i, first.get(k, i))
                docs[k].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(docs.get(key(x), ())) > 1 and first[key(x)] != i)]
        out[i, len(lines), len(lines) - len(keep), sha("\n".join(keep))] += 1
    return out


def rule_measures(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if counts[x] > 1 for j in range(5)}
    n, chars = len(w), sum(map(len, w))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, chars, symbols, dup, len(covered), failed


def repeated_windows(rows, width=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            first[x] = min(i, first.get(x, i))
    out = Counter()
    for i, t in rows:
        w = words(t)
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < i for j in range(width)}
        out[i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    return out
