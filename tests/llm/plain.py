"""Plain versions of the operators, one document or pair at a time."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile("[ \t-\r]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, k, percent):
    """(number of shingles, component) per row of (doc_id, text)."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in where[g])
        for g in s:
            where[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def cut_substrings(rows, length):
    """(bytes, removed, spans, sha256) per row of (doc_id, text); null ids come last."""
    order = lambda d: float("inf") if d is None else d
    first = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            first[b[i : i + length]] = min(order(doc_id), first.get(b[i : i + length], float("inf")))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < order(doc_id):
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cut_lines(rows, min_words):
    """Kept text per row of (doc_id, text), ids distinct: lines of runs that start earlier go."""
    docs = [(d, [(i, x, len(words(x))) for i, x in enumerate((t or "").split("\n")) if words(x)]) for d, t in sorted(rows, key=lambda r: r[0])]
    seen, gone = set(), set()
    for d, lines in docs:
        for i in range(len(lines)):
            total, run = 0, []
            for j in range(i, len(lines)):
                total += lines[j][2]
                run.append(lines[j][1])
                if total >= min_words:
                    if tuple(run) in seen:
                        gone |= {(d, lines[k][0]) for k in range(i, j + 1)}
                    seen.add(tuple(run))
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
