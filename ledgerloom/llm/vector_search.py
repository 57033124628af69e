"""Exact top-k search by multi-resolution segment statistics.

A vector is divided into 1, then 4, then 16 segments, and each segment is known by its mean
and its deviation (the length of the rest). Between two vectors the statistics of a level
give a lower bound of the squared distance, sum over segments of
n (mean difference)^2 + (deviation difference)^2, and so an upper bound of the inner product.
Candidates whose bound can't reach a query's k-th best go, level by level; the inner product
itself is computed for the survivors. Nothing is approximate.

A bound over all pairs of a block is one matrix product of the statistics, twice as long as
there are segments. Queries go in blocks of bounded size, each broadcast with a first
threshold: its k-th best score among the queries of its own block. Every task keeps k
candidates a query, and the last step ranks those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ledgerloom.llm.common import stored

LEVELS = (1, 4, 16)
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
_FOUND = StructType().add("query_id", LongType()).add("vec_id", LongType()).add("score", LongType())


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """``id`` and ``v``: floor(scale x) of each component, as doubles that hold whole numbers.

    Vectors that are null, empty or hold a null or non-finite component are left out, and so
    are rows with a null id.
    """
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & (F.size(vector_column) > 0) & whole
    return vectors.where(usable).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v"),
    )


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the vectors from above: root(n) times the mean
    and the deviation of each segment."""
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    means, rests = [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = vectors[:, a:b]
        mean = part.mean(axis=1)
        means.append(mean * np.sqrt(b - a))
        rests.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.column_stack(means + rests)


def _keep_best(best: dict, q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Merge hits into the k best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else []
    for a, b in zip(starts, [*starts[1:], len(q)], strict=True):
        old = best.get(q[a], [])
        new = list(zip((-scores[a : min(b, a + k)]).tolist(), ids[a : min(b, a + k)].tolist(), strict=True))
        best[q[a]] = sorted(old + new)[:k]


def first_thresholds(vectors: np.ndarray, k: int) -> np.ndarray:
    """Queries are candidates of each other: a first bound on each one's k-th best score."""
    if len(vectors) <= k:
        return np.full(len(vectors), -np.inf)
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    return np.partition(scores, -k, axis=1)[:, -k]


class QueryBlock:
    """Queries of one length, their statistics and thresholds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [_statistics(vectors, s) for s in LEVELS]

    def search(self, best: dict, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take a block of candidates into ``best``; ``least`` rises with it."""
        columns = np.arange(len(ids))
        open_ = None
        for queries, segments in zip(self.levels, LEVELS, strict=True):
            bound = queries @ _statistics(vectors[columns], segments).T
            # Whole numbers: rounding can't hide a score that reaches the threshold.
            fits = bound + 1e-6 * (1 + np.abs(bound)) >= least[:, None]
            open_ = fits if open_ is None else open_ & fits
            some = open_.any(axis=0)
            columns, open_ = columns[some], open_[:, some]
            if not len(columns):
                return
        q, c = np.nonzero(open_)
        if len(q) * 4 > open_.size:  # most of the block: one matrix product
            scores = (self.vectors @ vectors[columns].T)[q, c]
        else:
            scores = np.empty(len(q))
            for a in range(0, len(q), 1 << 16):
                s = slice(a, a + (1 << 16))
                scores[s] = np.einsum("ij,ij->i", self.vectors[q[s]], vectors[columns[c[s]]])
        hit = (scores >= least[q]) & (self.ids[q] != ids[columns[c]])
        q, found, scores = q[hit], ids[columns[c[hit]]], scores[hit]
        _keep_best(best, q, found, scores, self.k)
        for i in np.unique(q):
            if len(best[i]) == self.k:
                least[i] = max(least[i], -best[i][-1][0])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products per query.

    Candidates are all rows but those with the query's own id; ties go to the smaller id.
    Vectors of another length than the query's are no candidates. Null ids and vectors that
    are null, empty or hold null or non-finite components take no part. Of repeated query ids
    the smallest vector asks; repeated candidates all count. An empty table gives no rows.
    ``is_query`` is a condition over ``id``.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_column, vector_column, scale)
    queries = stored(rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-queries.count() // query_block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    parts = []
    for block in range(blocks):  # each holds about query_block queries, whatever there is in all
        by_length: dict[int, list] = {}
        for q in queries.where(F.col("block") == block).collect():
            by_length.setdefault(len(q["v"]), []).append((q["id"], q["v"]))
        sent = {}
        for n, got in by_length.items():
            ids, v = np.array([i for i, _ in sorted(got)]), np.array([v for _, v in sorted(got)])
            sent[n] = (ids, v, first_thresholds(v, k))
        held = spark.sparkContext.broadcast(sent)

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            blocks = {n: QueryBlock(ids, v, k) for n, (ids, v, _) in held.value.items()}
            best = {n: {} for n in blocks}
            least = {n: first.copy() for n, (_, _, first) in held.value.items()}
            for batch in batches:
                ids, lists = batch["id"].to_numpy(), batch["v"].to_numpy()
                lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
                for n in np.unique(lengths):
                    if n not in blocks:
                        continue
                    at = np.flatnonzero(lengths == n)
                    for a in range(0, len(at), CANDIDATE_BLOCK):
                        some = at[a : a + CANDIDATE_BLOCK]
                        blocks[n].search(best[n], least[n], ids[some], np.stack(lists[some]))
            found = [
                (int(blocks[n].ids[q]), i, int(-s)) for n in best for q, hits in best[n].items() for s, i in hits
            ]
            yield pd.DataFrame(found, columns=_FOUND.names).astype("int64")

        parts.append(rows.mapInPandas(search, _FOUND))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
