"""Ranked lexical search: exact inner products over a forest of sparse ball trees.

A document is a sparse vector of integer impacts over the terms that queries ask for, a query holds the weights of its
terms, and the score is their inner product. Documents are put into leaves of similar ones: each task splits blocks of
its documents again and again along the line between two far members (in a hashed sketch; splits steer cost only).
Leaves are written once, a row each, and neighbouring leaves are joined to nodes two by two.

A node keeps its centroid c, the radius R around it, and the upward radius r_t along each of its terms. No member can
score more than  q.c + min(|q| R, sum of q_t r_t).  The plain ball alone is far too wide in thousands of dimensions;
the radii along the terms are what prunes. Bounds are doubles, enlarged by far more than their rounding. Scores are
integers: products of doubles where every partial sum is a whole number below 2^53, else 64-bit integers.

A first pass scores each query's most promising leaf of every tree; the k-th best of these is a floor that every
answer reaches. The second pass descends from the roots, drops nodes below a query's floor, and scores the leaves that
are left, best first, raising the floor as it goes. A task keeps k candidates for each query, whatever the number of
ties. Documents are never shuffled; queries go out in blocks of bounded size, each against all documents.

Defined results: terms are as the contract names them; null and empty texts have none, and such documents are found by
no query but a null ``doc_id`` is like any other and comes last among equal scores. Every row of ``documents`` is a
document and every row of ``queries`` a query of its own, also where ids repeat; a query without terms finds nothing.
Empty tables give no rows; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorqc.llm.base import arrow_map, materialise, texts_of

#: Bytes that separate terms become blanks, A-Z become a-z, all others stay.
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))

#: Sorts null ids behind all others of equal score.
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class RankSettings:
    k: int = 50
    block_bytes: int = 1 << 17  # query texts in one block, 64 bytes a query included
    tree: int = 4096  # documents in one tree
    leaf: int = 32  # documents in one leaf
    cells: int = 4 << 20  # numbers in one matrix of node bounds


def terms_of(text: bytes, span: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text, listed at most about ``span`` bytes at a time."""
    low = text.translate(_TERM_BYTES)
    at = 0
    while at < len(low):
        end = low.find(b" ", at + span) if at + span < len(low) else -1
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end


class QueryBlock:
    """Queries of one block: row ids, item ids, and their terms as a dense 0/1 matrix over the block's vocabulary."""

    def __init__(self, rows: list):
        sets = [(r["rid"], r["item"], {t for part in terms_of(r["text"].encode()) for t in part}) for r in rows]
        self.rows = sorted((x for x in sets if x[2]), key=lambda x: x[0])
        self.vocab = {t: i for i, t in enumerate(sorted(set().union(*(x[2] for x in self.rows))))}
        self.has = np.zeros((len(self.rows), len(self.vocab)), bool)
        for q, (_, _, terms) in enumerate(self.rows):
            self.has[q, [self.vocab[t] for t in terms]] = True


def _rows(small: DataFrame) -> list:
    """Rows of a table whose size is bounded by a parameter (queries or terms of one block)."""
    return small.agg(F.collect_list(F.struct(*small.columns)).alias("rows")).first()["rows"]


def _query_blocks(queries: DataFrame, cfg: RankSettings) -> Iterator[QueryBlock]:
    kept = queries.select(F.col("item_id").alias("item"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    kept = materialise(kept, "queries")
    size = kept.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // cfg.block_bytes)
    for i in range(blocks):
        rows = _rows(kept.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == i))
        block = QueryBlock(rows)
        if block.rows:
            yield block


def count_terms(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms and times (little-endian int32 and int64 arrays) of the terms in ``vocab``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for b in batches:
            sizes, terms, times = [], [], []
            for text in texts_of(b.column("text")):
                n, found = 0, np.zeros(0, np.int64)
                for words in terms_of(text):
                    n += len(words)
                    found = np.concatenate([found, np.array([i for i in map(get, words) if i is not None], np.int64)])
                ids, counts = np.unique(found, return_counts=True)
                sizes.append(n)
                terms.append(ids.astype("<i4").tobytes())
                times.append(counts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "n", "terms", "times"]
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n long, terms binary, times binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """df of every term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "n"])

    df = np.zeros(size, np.int64)
    for r in _rows(arrow_map(vectors.select("terms"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))):
        df[r["term"]] = r["n"]
    return df


def impacts(times: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The contract's part of a score that the weight multiplies; at most 10^6."""
    m = 100 - 50 + (50 * n * docs) // total
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


def _order(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Groups of at most ``leaf`` near rows: halves along the line between two far rows, again and again, in order."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        z = points[rows]
        far = z[((z - z.mean(0)) ** 2).sum(1).argmax()]
        other = z[((z - far) ** 2).sum(1).argmax()]
        along = np.argsort(z @ (other - far), kind="stable")
        half = leaf * -(-len(rows) // (2 * leaf))
        todo += [rows[along[half:]], rows[along[:half]]]
    return done


def build_leaves(vectors: DataFrame, weights: np.ndarray, docs: int, total: int, cfg: RankSettings, dims: int = 256) -> DataFrame:
    """One row per leaf, in the order of its tree: ids (nullable), sizes, terms and impacts of its documents."""
    sent = vectors.sparkSession.sparkContext.broadcast(weights)

    def leaves(held: list[tuple]) -> pa.RecordBatch:
        weights = sent.value
        sketch = np.zeros((len(held), dims), np.float32)
        for i, (_, terms, x) in enumerate(held):
            sketch[i] = np.bincount(terms % dims, weights[terms] * x, dims)
        cols = [[], [], [], []]
        for rows in _order(sketch, cfg.leaf):
            some = [held[i] for i in rows]
            cols[0].append([d for d, _, _ in some])
            cols[1].append(np.array([len(t) for _, t, _ in some], "<i4").tobytes())
            cols[2].append(np.concatenate([t for _, t, _ in some]).astype("<i4").tobytes())
            cols[3].append(np.concatenate([x for _, _, x in some]).astype("<i4").tobytes())
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.list_(pa.int64())), *(pa.array(c, pa.binary()) for c in cols[1:])], ["ids", "sizes", "terms", "impacts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0
        for b in batches:
            for doc, n, terms, times in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "terms", "times")), strict=True):
                terms = np.frombuffer(terms, "<i4")
                held.append((doc, terms, impacts(np.frombuffer(times, "<i8"), np.int64(n), docs, total)))
                cells += len(terms)
                if len(held) >= cfg.tree or cells >= cfg.cells:
                    yield leaves(held)
                    held, cells = [], 0
        if held:
            yield leaves(held)

    return arrow_map(vectors.filter(F.octet_length("terms") > 0), run, "ids array<long>, sizes binary, terms binary, impacts binary")


class Leaf:
    def __init__(self, ids: list, sizes: bytes, terms: bytes, impacts_: bytes):
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.null = np.array([i is None for i in ids], bool)
        sizes = np.frombuffer(sizes, "<i4")
        self.terms, at = np.unique(np.frombuffer(terms, "<i4"), return_inverse=True)
        self.x = np.zeros((len(ids), len(self.terms)))
        self.x[np.repeat(np.arange(len(ids)), sizes), at] = np.frombuffer(impacts_, "<i4")


class Tree:
    """Nodes over consecutive leaves: level 0 are the leaves, each further level joins two nodes."""

    def __init__(self, leaves: list[Leaf]):
        self.leaves = leaves
        self.terms = np.unique(np.concatenate([x.terms for x in leaves]))
        n, c, hi, radius = [], np.zeros((len(leaves), len(self.terms))), np.zeros((len(leaves), len(self.terms))), []
        for i, leaf in enumerate(leaves):
            at = np.searchsorted(self.terms, leaf.terms)
            mean = leaf.x.mean(0)
            c[i, at], hi[i, at] = mean, leaf.x.max(0)
            radius.append(np.sqrt(((leaf.x - mean) ** 2).sum(1).max()))
            n.append(len(leaf.ids))
        self.levels = [(np.array(n, float), c, hi, np.array(radius))]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._join(*self.levels[-1]))

    @staticmethod
    def _join(n: np.ndarray, c: np.ndarray, hi: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, ...]:
        first = np.arange(0, len(n), 2)
        parent = np.arange(len(n)) // 2
        total = np.add.reduceat(n, first)
        centre = np.add.reduceat(c * n[:, None], first) / total[:, None]
        reach = np.sqrt(((c - centre[parent]) ** 2).sum(1)) + radius
        return total, centre, np.maximum.reduceat(hi, first), np.maximum.reduceat(reach, first)

    def bounds(self, level: int, nodes: np.ndarray, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of all queries in the given nodes; ``q`` holds the weights of the tree's terms."""
        _, c, hi, radius = (x[nodes] for x in self.levels[level])
        centre = q @ c.T
        ball = centre + norm[:, None] * radius
        along = q @ np.maximum(hi, c).T  # q.c plus the sum of q_t r_t
        return np.minimum(ball, along) * (1 + 1e-9) + 1


class Best:
    """The k best candidates of each query so far, and the floor below which none is wanted."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors.copy(), k
        self.found: list[list[tuple[np.ndarray, ...]]] = [[] for _ in floors]
        self.held = np.zeros(len(floors), np.int64)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero((score >= self.floors[q]) & (score > 0))
        if len(at):
            self.found[q].append((score[at], ids[at], null[at]))
            self.held[q] += len(at)
            if self.held[q] >= 2 * self.k:
                self.trim(q)

    def trim(self, q: int) -> tuple[np.ndarray, ...]:
        """Keeps the k best, ties to smaller ids; the k-th is the new floor."""
        if not self.found[q]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        score, ids, null = (np.concatenate(x) for x in zip(*self.found[q], strict=True))
        keep = np.lexsort((ids, null, -score))[: self.k]
        self.found[q] = [(score[keep], ids[keep], null[keep])]
        self.held[q] = len(keep)
        if len(keep) == self.k:
            self.floors[q] = max(self.floors[q], score[keep[-1]])
        return self.found[q][0]


def _scores(leaf: Leaf, w: np.ndarray, exact: bool) -> np.ndarray:
    """Integer scores: queries by documents."""
    q = w[:, leaf.terms]
    if exact:
        return (q @ leaf.x.T).astype(np.int64)
    return q.astype(np.int64) @ leaf.x.astype(np.int64).T


def _search_tree(tree: Tree, w: np.ndarray, exact: bool, best: Best, first_only: bool) -> None:
    q = w[:, tree.terms]
    norm = np.sqrt((q**2).sum(1))
    alive, nodes = np.ones((len(w), 1), bool), np.array([0])
    for level in range(len(tree.levels) - 1, -1, -1):
        bound = tree.bounds(level, nodes, q, norm)
        alive = alive & (bound >= best.floors[:, None]) & (bound > 1.5)  # a bound of 1 is the margin alone: no common term
        if level:
            some = np.flatnonzero(alive.any(0))
            if not len(some):
                return
            size = len(tree.levels[level - 1][0])
            child = np.stack([2 * nodes[some], 2 * nodes[some] + 1], 1).ravel()
            alive = np.repeat(alive[:, some], 2, 1)[:, child < size]
            nodes = child[child < size]
    bound = np.where(alive, bound, -1.0)
    if first_only:
        top = bound.argmax(1)
        wanted = [(j, np.flatnonzero((top == j) & (bound[:, j] > 0))) for j in np.unique(top)]
    else:
        wanted = ((j, np.flatnonzero((bound[:, j] >= best.floors) & (bound[:, j] > 0))) for j in np.argsort(-bound.max(0), kind="stable"))
    for j, queries in wanted:
        if len(queries):
            leaf = tree.leaves[nodes[j]]
            for i, score in zip(queries, _scores(leaf, w[queries], exact), strict=True):
                best.add(i, score, leaf.ids, leaf.null)


def _trees(batches: Iterator[pa.RecordBatch], most: int, cfg: RankSettings) -> Iterator[Tree]:
    """Trees over consecutive leaves; ``most`` is the size of the vocabulary."""
    held, cells = [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("ids", "sizes", "terms", "impacts")), strict=True):
            leaf = Leaf(*row)
            if held and (len(held) * cfg.leaf >= cfg.tree or (len(held) + 1) * min(cells + len(leaf.terms), most) > cfg.cells):
                yield Tree(held)
                held, cells = [], 0
            held.append(leaf)
            cells += len(leaf.terms)  # no fewer than the columns of the tree
    if held:
        yield Tree(held)


def _search(leaves: DataFrame, block: QueryBlock, weights: np.ndarray, floors: np.ndarray, cfg: RankSettings, first_only: bool) -> DataFrame:
    """q, doc_id, is_null, score: each task's candidates."""
    sent = leaves.sparkSession.sparkContext.broadcast((block.has, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, weights, floors = sent.value
        w = np.where(has, weights, 0.0)
        exact = w.sum(1).max() * 1e6 < 2**53
        best = Best(floors, cfg.k)
        for tree in _trees(batches, w.shape[1], cfg):
            _search_tree(tree, w, exact, best, first_only)
        kept = [best.trim(q) for q in range(len(w))]
        q = np.repeat(np.arange(len(w)), [len(x[0]) for x in kept])
        score, ids, null = (np.concatenate([x[i] for x in kept]) for i in range(3))
        fine = score >= best.floors[q]
        cols = [pa.array(q[fine], pa.int64()), pa.array(ids[fine], pa.int64(), mask=null[fine]), pa.array(score[fine], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, ["q", "doc_id", "score"])

    return arrow_map(leaves, run, "q long, doc_id long, score long")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: QueryBlock, item_type: str, cfg: RankSettings) -> DataFrame | None:
    vectors = materialise(count_terms(docs, block.vocab), "term-counts")
    n, total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    if not total:
        return None
    df = _document_counts(vectors, len(block.vocab))
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1)))
    leaves = materialise(build_leaves(vectors, weights, n, total, cfg), "leaves")
    floors = np.zeros(len(block.rows), np.int64)
    for r in _rows(_best_of(_search(leaves, block, weights, floors, cfg, True), cfg.k).filter(F.col("rank") == cfg.k).select("q", "score")):
        floors[r["q"]] = r["score"]
    found = _best_of(_search(leaves, block, weights, floors, cfg, False), cfg.k)
    items = found.sparkSession.createDataFrame([(q, item) for q, (_, item, _) in enumerate(block.rows)], f"q long, item_id {item_type}")
    # as many rows as queries in one block
    return found.join(F.broadcast(items), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, cfg: RankSettings = RankSettings()) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each query (item_id, text)."""
    kind = queries.schema["item_id"].dataType.simpleString()
    found = [_search_block(docs, block, kind, cfg) for block in _query_blocks(queries, cfg)]
    found = [f for f in found if f is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
