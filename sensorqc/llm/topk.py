"""Exact top-k search by distributed histogram selection.

Queries go out in blocks of bounded size; every task scores its candidates against a block (an integer
matrix product) and counts the scores of each query in the bins of that query's current score range. The
summed counts tell which bin holds the k-th highest score, that bin becomes the next range, and after a few
rounds the range is a single value: the exact k-th score. A last pass keeps what scores higher and, of the
equal scores, the smallest ids that are still needed. Per query and task at most k bins or rows leave a
task, whatever the number of ties. Candidates are read where they lie and never shuffled.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part; a query
meets only vectors of its own length; every row is a vector of its own, so rows that share a query's id are
candidates like others, and each query row is asked for itself; a row without an id comes last among equal
scores; other columns are ignored. Components and scores are 64-bit integers; a table whose scores could pass
them is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorqc.llm.base import arrow_map, materialise


@dataclass(frozen=True)
class SearchSettings:
    k: int = 5
    scale: int = 256
    block: int = 2048  # queries in one block
    bins: int = 256


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v, row: the vectors that take part, as arrays of long, written once with a number for each row."""
    v = F.col(vector_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return materialise(df.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; as doubles where no partial sum can leave their whole numbers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _blocks(queries: DataFrame, cfg: SearchSettings) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, ids, rows, matrix) of the queries, about ``block`` at a time."""
    asked = materialise(queries.select("vec_id", "v", "row", F.size("v").alias("dim")), "queries")
    for dim, n in ((r["dim"], r["n"]) for r in _rows(asked.groupBy("dim").agg(F.count(F.lit(1)).alias("n")))):
        slots = -(-n // cfg.block)
        of_dim = asked.filter(F.col("dim") == dim).withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(slots)))
        for s in range(slots):
            got = of_dim.filter(F.col("slot") == s).agg(*[F.collect_list(c).alias(c) for c in ("vec_id", "row")], F.flatten(F.collect_list("v")).alias("v")).first()
            if got["row"]:
                ids, rows, m = np.array(got["vec_id"], np.int64), np.array(got["row"], np.int64), np.array(got["v"], np.int64).reshape(-1, dim)
                order = np.argsort(rows)
                yield dim, ids[order], rows[order], m[order]


def _rows(small: DataFrame) -> list:
    """Rows of a table whose size is bounded by a parameter (bins or queries of one block, vector lengths)."""
    return small.agg(F.collect_list(F.struct(*small.columns)).alias("rows")).first()["rows"]


def top_k(vectors: DataFrame, queries: DataFrame, cfg: SearchSettings = SearchSettings()) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query, ties to smaller vec_id.

    Both are tables of ``integer_vectors``; a query with an id is a row of it, and no candidate for itself.
    """
    spark = vectors.sparkSession
    found = []
    for dim, ids, rows, m in _blocks(queries.filter("vec_id is not null"), cfg):
        names = spark.createDataFrame(list(zip(rows.tolist(), ids.tolist(), strict=True)), "query long, query_id long")
        # no more rows than a block has queries
        found.append(_search_block(vectors.filter(F.size("v") == dim), rows, m, cfg).join(F.broadcast(names), "query"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    rows = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best).cast("int"))
    return rows.filter(F.col("rank") <= cfg.k).select("query_id", "rank", "vec_id", "score")


def _search_block(vectors: DataFrame, own: np.ndarray, queries: np.ndarray, cfg: SearchSettings) -> DataFrame:
    """query (its row), vec_id, score: what each task can't rule out."""
    spark, n, k = vectors.sparkSession, len(own), cfg.k
    most = vectors.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0] or 0
    # as Python integers, which can't overflow
    reach = max(sum(abs(x) for x in q) for q in queries.tolist()) * int(most) + 1
    if reach >= 1 << 61:
        raise ValueError("components are too large for scores of 64 bits")
    low = np.full(n, -reach, object)  # each query's range is [low, low + span), cut into bins of the same width
    span = 2 * reach
    above = np.zeros(n, np.int64)  # scores beyond the range
    while True:
        lows, width = low.astype(np.int64), -(-span // cfg.bins)
        state = spark.sparkContext.broadcast((own, queries, lows, span, width))

        def count(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            own, queries, lows, span, width = state.value
            total = np.zeros((len(own), cfg.bins), np.int64)
            rows = np.arange(len(own))[:, None]
            for b in batches:
                c = b.column("row").to_numpy()
                past = inner_products(queries, _matrix(b.column("v"))) - lows[:, None]
                inside = (past >= 0) & (past < span) & (c[None, :] != own[:, None])
                at = past // width
                total += np.bincount((rows * cfg.bins + at)[inside], minlength=total.size).reshape(total.shape)
            # bins below a task's own k-th score can't hold the k-th of all
            higher = np.cumsum(total[:, ::-1], 1)[:, ::-1] - total
            q, bin_ = np.nonzero((total > 0) & (higher < k))
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(bin_, pa.int64()), pa.array(total[q, bin_], pa.int64())], ["q", "bin", "n"])

        counts = np.zeros((n, cfg.bins), np.int64)
        for r in _rows(arrow_map(vectors, count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))):
            counts[r["q"], r["bin"]] = r["n"]
        upto = above[:, None] + np.cumsum(counts[:, ::-1], 1)[:, ::-1]
        enough = upto >= k
        kth = np.where(enough.any(1), cfg.bins - 1 - np.argmax(enough[:, ::-1], 1), 0)  # too few candidates: down to the lowest
        above = upto[np.arange(n), kth] - counts[np.arange(n), kth]
        low = low + kth * width
        if width == 1:
            break
        span = width
    state = spark.sparkContext.broadcast((own, queries, low.astype(np.int64), np.maximum(k - above, 0)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries, kth, ties = state.value
        equal: dict[int, np.ndarray] = {}
        for b in batches:
            c, row = b.column("vec_id").fill_null(_NO_ID).to_numpy(), b.column("row").to_numpy()
            s = inner_products(queries, _matrix(b.column("v")))
            other = row[None, :] != own[:, None]
            q, at = np.nonzero((s > kth[:, None]) & other)
            yield _found(own[q], c[at], s[q, at])
            tied = (s == kth[:, None]) & other
            for q in np.flatnonzero(tied.any(1)):
                both = np.concatenate([equal.get(q, np.zeros(0, np.int64)), c[tied[q]]])
                equal[q] = np.sort(both)[: ties[q]]
        q = np.repeat(np.array(list(equal), np.int64), [len(x) for x in equal.values()])
        if len(q):
            yield _found(own[q], np.concatenate(list(equal.values())), kth[q])

    return arrow_map(vectors, keep, "query long, vec_id long, score long")


#: Stands for a missing id in sorting, behind all others.
_NO_ID = np.iinfo(np.int64).max


def _found(q: np.ndarray, c: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64(), mask=c == _NO_ID), pa.array(s, pa.int64())], ["query", "vec_id", "score"])
