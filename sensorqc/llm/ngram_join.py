"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct k-word shingles (64-bit hashes, 128-bit set keys). Two documents
link when ``100 * intersection >= percent * union``. Documents with equal sets form one class and are
joined through one representative; between classes no link is lost.

Prefixes. Tokens are ordered by hash. With overlap bound o = ceil(percent * n / 100), the l-prefix of a
set of n tokens is its first n - o + l tokens; linked sets share at least min(l, l') tokens within their
prefixes. Posting lengths of all prefix tokens are counted exactly. Each document then lengthens its
prefix to the l of lowest estimated cost (posting rows, plus verifications, which fall as more shared
tokens are asked for). Tokens with over ``hot`` postings are never enumerated: a document whose l-prefix
holds h of them asks for l - h shared other tokens, so l grows until that is at least 1.

Dominated documents, whose longest prefix is full of hot tokens, are matched with the others through
their other tokens as above. Among themselves they are first gathered around central documents: those that
share a min-hash are verified against the one with the fewest rare tokens, one row each. Then they are joined
over prefixes in the order of rising frequency, but only across the components found so far, only where the
positions of the first shared token leave room for the overlap, and only where their parity sketches differ in
no more bits than linked sets may differ in tokens. All three tests keep every linked pair, so the result is
whole, and pairs inside a large group of copies are never formed.

Candidates are verified on the whole sets; pairs already in one component need no verification.

Defined results: null, empty and word-less texts have the empty set, n = 0, and stay alone; rows that
repeat an id are joined by their texts; null ids never name a component unless all of it is null; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.llm.base import arrow_map, id_filter, materialise, texts_of
from sensorqc.llm.graph import components
from sensorqc.llm.shingles import WordHashes, min_hashes, parity_sketch, set_key, shingle_set


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5
    percent: int = 80
    hot: int = 16
    slack: int = 8
    slack_part: int = 20
    verify_cost: float = 40.0
    star_rounds: int = 4
    sketch_bits: int = 512


def overlap_bound(n, percent: int):
    """ceil(percent * n / 100), for a number or an array."""
    return -((-percent * n) // 100)


def longest(n, cfg: JoinSettings):
    """The largest l that every document of n tokens is indexed with."""
    return np.minimum(overlap_bound(n, cfg.percent), cfg.slack + n // cfg.slack_part)


def sketch(docs: DataFrame, cfg: JoinSettings) -> DataFrame:
    """rid, doc_id, n, key, tokens: one row per document with its longest prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            sizes, keys, heads = [], [], []
            for t in texts_of(b.column("_nj_text")):
                s = shingle_set(t, cfg.words, words)
                n = len(s)
                sizes.append(n)
                keys.append(set_key(s) if n else None)
                heads.append(s[: n - overlap_bound(n, cfg.percent) + int(longest(n, cfg))] if n else s)
            offsets = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(heads) if heads else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), tokens], ["doc_id", "n", "key", "tokens"])

    rows = docs.select("doc_id", F.col("text").alias("_nj_text"))
    out = arrow_map(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, key binary, tokens array<long>")
    return materialise(out.withColumn("rid", F.monotonically_increasing_id()), "shingle-prefixes")


def whole_sets(docs: DataFrame, wanted: DataFrame, cfg: JoinSettings) -> DataFrame:
    """rid, n, tokens (all), anchors (min-hashes), parity (sketch) of the documents in ``wanted`` (rid, doc_id, key)."""
    wanted = materialise(wanted, "wanted-sets")
    maybe = id_filter(wanted.select("doc_id"))
    text = docs.select("doc_id", F.col("text").alias("_nj_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            b = b.filter(pa.array(maybe(b.column("doc_id")), pa.bool_()))
            sets = [shingle_set(t, cfg.words, words) for t in texts_of(b.column("_nj_text"))]
            sets = [s for s in sets if len(s)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            anchors = pa.array([min_hashes(s, cfg.star_rounds) for s in sets], pa.list_(pa.int64()))
            parity = pa.array([parity_sketch(s, cfg.sketch_bits) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), tokens, anchors, parity], ["key", "n", "tokens", "anchors", "parity"])

    found = arrow_map(text, run, "key binary, n long, tokens array<long>, anchors array<long>, parity array<long>")
    found = found.join(wanted.select("rid", "key"), "key").drop("key")
    return materialise(found.dropDuplicates(["rid"]), "shingle-sets")


def choose_prefix(pos: np.ndarray, df: np.ndarray, n: int, limit: int, cfg: JoinSettings) -> tuple[int, int]:
    """(l, shared tokens to ask for) of lowest cost; (0, 0) if hot tokens fill every prefix.

    ``pos`` and ``df`` describe the document's tokens that occur in other prefixes too, by position.
    """
    base = n - int(overlap_bound(n, cfg.percent))
    ls = np.arange(1, limit + 1)
    ends = np.searchsorted(pos, base + ls, "left")  # tokens at positions < base + l
    is_hot = df > cfg.hot
    hot = np.concatenate([[0], np.cumsum(is_hot)])[ends]
    rows = np.concatenate([[0], np.cumsum(np.where(is_hot, 0, df - 1))])[ends]
    need = ls - hot
    ok = need >= 1
    if not ok.any():
        return 0, 0
    cost = np.where(ok, rows * (1 + cfg.verify_cost / np.maximum(need, 1)), np.inf)
    i = int(np.argmin(cost))
    return int(ls[i]), int(need[i])


def _bounded(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def prefix_candidates(nodes: DataFrame, cfg: JoinSettings) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, shared) between nodes (rid, n, tokens), and the dominated nodes (rid).

    Every linked pair is among the candidates, except pairs of two dominated nodes.
    """
    posts = nodes.select("rid", "n", F.posexplode("tokens").alias("pos", "token"))
    counts = posts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = posts.join(counts, "token").groupBy("rid", "n").agg(F.collect_list(F.struct("pos", "df", "token")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int, int, int, list[int]]] = []
            for rid, n, found in zip(b.column("rid").to_pylist(), b.column("n").to_pylist(), b.column("found"), strict=True):
                v = found.values
                pos, df, tok = (v.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                order = np.argsort(pos, kind="stable")
                pos, df, tok = pos[order], df[order], tok[order]
                o = int(overlap_bound(n, cfg.percent))
                top = int(longest(n, cfg))
                # a shorter partner, of o tokens at least, is indexed less far, and l may not pass that
                limit = max(1, min(top, int(longest(o, cfg))))
                l, need = choose_prefix(pos, df, n, limit, cfg)
                end = np.searchsorted(pos, n - o + (l or top), "left")
                keep = tok[:end][df[:end] <= cfg.hot]
                out.append((rid, n, l, need, keep.tolist()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["rid", "n", "l", "need", "keep"])

    chosen = materialise(arrow_map(shared, run, "rid long, n long, l int, need int, keep array<long>"), "prefix-choices")
    dominated = chosen.filter("l = 0").select("rid")
    rows = chosen.select("rid", "n", "l", "need", F.explode("keep").alias("token"))
    left, right = rows.alias("x"), rows.alias("y")
    pairs = left.join(right, (F.col("x.token") == F.col("y.token")) & (F.col("x.rid") < F.col("y.rid")) & _bounded(F.col("x.n"), F.col("y.n"), cfg.percent) & ((F.col("x.l") > 0) | (F.col("y.l") > 0)))
    far = F.lit(2**30)
    lx, ly = (F.when(F.col(c) > 0, F.col(c)).otherwise(far) for c in ("x.l", "y.l"))
    need = F.when(lx < ly, F.col("x.need")).when(ly < lx, F.col("y.need")).otherwise(F.greatest("x.need", "y.need"))
    pairs = pairs.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b"), need.alias("need"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("need").alias("need")).filter("shared >= need").drop("need"), dominated


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, distance of the pairs that reach ``percent``, by the exact sizes of intersection and union."""
    both = pairs.select("a", "b").join(sets.select(F.col("rid").alias("a"), F.col("tokens").alias("_nj_a")), "a")
    both = both.join(sets.select(F.col("rid").alias("b"), F.col("tokens").alias("_nj_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, (x, y) in enumerate(zip(b.column("_nj_a"), b.column("_nj_b"), strict=True)):
                s, t = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(s, t, assume_unique=True))
                union = len(s) + len(t) - common
                if 100 * common >= percent * union:
                    rows.append((i, 1 - common / union))
            keep = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep), pa.array([r[1] for r in rows], pa.float64())], ["a", "b", "distance"])

    return arrow_map(both.select("a", "b", "_nj_a", "_nj_b"), run, "a long, b long, distance double")


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends aren't in one component of ``known`` (node, root)."""
    for end in ("a", "b"):
        pairs = pairs.join(known.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    same = F.coalesce(F.col("root_a"), F.col("a")) == F.coalesce(F.col("root_b"), F.col("b"))
    return pairs.filter(~same).drop("root_a", "root_b")


def verified_links(pairs: DataFrame, sets: DataFrame, percent: int, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that connect what the candidate pairs connect; verifies each node's best partner first."""
    if known is not None:
        pairs = _apart(pairs, known)
    pairs = materialise(pairs, "candidates")
    best = pairs.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("m")).select((-F.col("m")["col2"]).alias("a"), "b")
    first = materialise(verify(best, sets, percent).select("a", "b"), "links")
    rest = _apart(pairs, components(first))
    return first.unionByName(materialise(verify(rest, sets, percent).select("a", "b"), "links"))


def central_links(sets: DataFrame, cfg: JoinSettings) -> DataFrame:
    """Verified links (a, b) from documents (with ``rare``) to the most central one that shares a min-hash."""
    out = None
    for i in range(cfg.star_rounds):
        rows = sets.select("rid", "rare", F.col("anchors")[i].alias("anchor"))
        head = rows.groupBy("anchor").agg(F.min(F.struct("rare", "rid")).alias("head")).select("anchor", F.col("head.rid").alias("b"))
        pairs = rows.join(head, "anchor").filter("rid <> b").select(F.col("rid").alias("a"), "b")
        out = pairs if out is None else out.unionByName(pairs)
    return materialise(verify(materialise(out.distinct(), "candidates"), sets, cfg.percent).select("a", "b"), "links")


def _dominated_links(sets: DataFrame, cfg: JoinSettings) -> DataFrame:
    """Links that connect the dominated nodes whose whole ``sets`` are given."""
    posts = sets.select("rid", F.explode("tokens").alias("token"))
    counts = posts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    ordered = posts.join(counts, "token").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ordered"))
    rare = F.size(F.filter("ordered", lambda x: x["df"] <= cfg.hot)) / F.col("n")
    # the plain prefix: the n - o + 1 rarest tokens, with o = ceil(percent * n / 100)
    reach = F.col("n") - F.ceil(F.col("n") * cfg.percent / F.lit(100)) + 1
    rows = sets.join(ordered, "rid").select("rid", "n", "tokens", "anchors", "parity", rare.alias("rare"), F.slice("ordered", F.lit(1), reach.cast("int")).alias("prefix"))
    rows = materialise(rows, "dominated")
    links = central_links(rows, cfg)
    known = components(links)
    named = rows.join(known.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    heads = named.select("rid", "n", "root", "parity", F.posexplode("prefix").alias("pos", "t")).select("rid", "n", "root", "parity", "pos", F.col("t.token").alias("token"))
    # tokens of one component can't add a link
    mixed = heads.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    heads = materialise(heads.join(mixed, "token", "left_semi"), "dominated-prefixes")
    x, y = heads.alias("x"), heads.alias("y")
    total = F.col("x.n") + F.col("y.n")
    differ = total - 2 * F.ceil(total * cfg.percent / F.lit(100 + cfg.percent))  # most tokens in which linked sets differ
    bits = reduce(lambda p, q: p + q, [F.bit_count(F.col("x.parity")[i].bitwiseXOR(F.col("y.parity")[i])) for i in range(cfg.sketch_bits // 64)])
    fits = (F.col("x.rid") < F.col("y.rid")) & (F.col("x.root") != F.col("y.root")) & _bounded(F.col("x.n"), F.col("y.n"), cfg.percent)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & fits & (F.col("x.pos") + F.col("y.pos") <= differ) & (bits <= differ))
    pairs = materialise(pairs.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct(), "candidates")
    return links.unionByName(materialise(verify(pairs, rows, cfg.percent).select("a", "b"), "links"))


def jaccard_components(docs: DataFrame, cfg: JoinSettings = JoinSettings()) -> DataFrame:
    """rid, doc_id, n_shingles, key, component_id: one row per document row.

    component_id is the smallest doc_id that links reach, the row's own included.
    """
    rows = sketch(docs, cfg)
    full = rows.filter("n > 0")
    classes = full.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("rid").alias("rep")).filter("rows > 1").drop("rows")
    member_of = materialise(full.select("rid", "key").join(classes, "key").select("rid", "rep"), "classes")
    nodes = full.join(member_of.filter("rid <> rep").select("rid"), "rid", "left_anti")
    pairs, dominated = prefix_candidates(nodes.select("rid", "n", "tokens"), cfg)
    pairs = materialise(pairs, "candidates")
    needed = reduce(DataFrame.unionByName, [pairs.select(F.col("a").alias("rid")), pairs.select(F.col("b").alias("rid")), dominated]).distinct()
    sets = whole_sets(docs, nodes.select("rid", "doc_id", "key").join(needed, "rid"), cfg)
    inner = _dominated_links(sets.join(dominated, "rid", "left_semi"), cfg)
    links = inner.unionByName(verified_links(pairs, sets, cfg.percent, components(inner)))
    roots = components(links)
    out = rows.select("rid", "doc_id", "n", "key").join(member_of, "rid", "left")
    out = out.withColumn("node", F.coalesce("rep", "rid")).join(roots, "node", "left")
    out = materialise(out.select("rid", "doc_id", F.col("n").alias("n_shingles"), "key", F.coalesce("root", "node").alias("root")), "components")
    # equal roots may hold a third of all rows: the minimum is combined before the shuffle
    least = out.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    many = out.join(least.filter("rows > 1").drop("rows"), "root", "left")
    return many.select("rid", "doc_id", "n_shingles", "key", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, cfg: JoinSettings = JoinSettings()) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row of the smallest doc_id stays (rows without words all stay)."""
    found = jaccard_components(docs, cfg).filter("doc_id is not null and n_shingles > 0")
    drop = materialise(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_nj_id")).distinct(), "near-duplicates")
    return docs.join(drop, docs["doc_id"] == drop["_nj_id"], "left_anti")
