"""Lexical search against scoring everything, and the bounds that it prunes by."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sensorqc.llm import base
from sensorqc.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score long, q long, terms string"
ITEMS = "item_id long, text string, rank int, rid long"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    bags = [Counter(terms(t)) for _, t in docs]
    n = sum(bool(b) for b in bags)
    total = sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc_id, _), b in zip(docs, bags, strict=True):
            m = 100 - 50 + (50 * sum(b.values()) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2] or 0))


def result(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2] or 0))


def frames(spark, docs, items):
    base.prepare(spark)
    d = spark.createDataFrame([(i, t, 1, 2, "clash") for i, t in docs], DOCS).repartition(4)
    return d, spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)


def corpus(seed, docs, items):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)] + ["Über", "naïve", "日本", "A1", "X-y"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)) + rng.choice([".", "!", ""])
    rows = [(i, text(rng.randrange(0, 60))) for i in range(docs)]
    rows += [(None, text(20)), (None, None), (5, ""), (5, text(9)), (7, rows[7][1])]
    copy = text(30)
    rows += [(10_000 + i, copy) for i in range(300)]  # more equal scores than answers
    asked = [(i, text(rng.randrange(1, 25))) for i in range(items)] + [(0, copy), (0, copy), (None, text(5)), (99, None), (98, "?!"), (97, "unknownword")]
    return rows, asked


@pytest.mark.parametrize("cfg", [ls.RankSettings(k=10), ls.RankSettings(k=50, tree=64, leaf=4), ls.RankSettings(k=3, block_bytes=400, tree=100, leaf=8, cells=2000)])
def test_equals_plain(spark, cfg):
    docs, items = corpus(3, 500, 25)
    assert result(ls.search(*frames(spark, docs, items), cfg)) == plain(docs, items, cfg.k)


def test_long_text_and_wide_vocabulary(spark):
    rng = random.Random(5)
    long = " ".join(f"t{rng.randrange(40_000)}" for _ in range(400_000))
    docs = [(1, long), (2, "t1 t2 t3"), (3, "t5 " * 100_000), (4, None)]
    items = [(1, " ".join(f"t{i}" for i in range(20_000))), (2, "t5")]
    assert result(ls.search(*frames(spark, docs, items))) == plain(docs, items, 50)
    assert sum(len(p) for p in ls.terms_of(long.encode(), 1000)) == 400_000


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert ls.search(docs.limit(0), items).count() == 0
    assert ls.search(docs, items.limit(0)).count() == 0
    assert ls.search(docs.withColumn("text", docs.terms.substr(1, 0)), items).count() == 0


def test_no_bound_is_below_a_score_and_subtrees_are_pruned():
    rng = np.random.default_rng(2)
    leaves = []
    for _ in range(40):
        topic = rng.choice(60, 8, replace=False)
        rows = [np.sort(rng.choice(topic, rng.integers(1, 8), replace=False)) for _ in range(6)]
        leaves.append(ls.Leaf(list(range(6)), np.array([len(r) for r in rows], "<i4").tobytes(), np.concatenate(rows).astype("<i4").tobytes(), rng.integers(1, 10**6, sum(map(len, rows))).astype("<i4").tobytes()))
    tree = ls.Tree(leaves)
    w = np.where(rng.random((12, 60)) < 0.1, rng.integers(1, 9000, (12, 60)), 0).astype(float)
    q = w[:, tree.terms]
    norm = np.sqrt((q**2).sum(1))
    exact = [ls._scores(leaf, w, True).max(1) for leaf in leaves]
    for level in range(len(tree.levels)):
        nodes = np.arange(len(tree.levels[level][0]))
        bound = tree.bounds(level, nodes, q, norm)
        for i, score in enumerate(exact):
            assert (bound[:, i >> level] >= score).all()
    assert (ls._scores(leaves[0], w, True) == ls._scores(leaves[0], w, False)).all()
    seen = []
    counted = ls._scores
    ls._scores = lambda leaf, w, exact: seen.append(len(w)) or counted(leaf, w, exact)
    try:
        ls._search_tree(tree, w, True, ls.Best(np.zeros(12, np.int64), 3), False)
    finally:
        ls._scores = counted
    assert sum(seen) < 0.6 * 12 * len(leaves)
