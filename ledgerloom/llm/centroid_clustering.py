"""Clustering by centroids, the nearest one found by the threshold algorithm.

For each dimension the centroids lie in a sorted list. From a vector's value in that dimension
the list is walked outward, the nearer of the next smaller and the next larger entry first. A
step takes one entry from the list of every dimension; centroids met for the first time get
their exact distance. The distances of the entries just taken, squared and added up, bound
the distance of every centroid not met so far, so a vector is done when that sum is greater
than its best exact distance. Equal sums go on, since a tie goes to the smaller number.

All arithmetic is on whole numbers. A round is one pass over the stored vectors: tasks send a
sum for each centroid and dimension, never vectors, and what the driver holds are centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from ledgerloom.llm.common import stored

BLOCK = 4096
_FAR = np.iinfo(np.int64).max


class SortedCentroids:
    """Centroids as one sorted list for each dimension."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.count, self.dimensions = centroids.shape
        self.number = np.argsort(centroids, axis=0, kind="stable")
        self.value = np.take_along_axis(centroids, self.number, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid, ties to the smaller number,
        and how many exact distances it took in all."""
        n = len(vectors)
        best = np.full(n, _FAR)
        found = np.zeros(n, dtype=np.int64)
        met = np.zeros((n, self.count), dtype=bool)
        dims = np.arange(self.dimensions)
        # The next entry above and below in each list: places of the two walkers.
        above = np.empty(vectors.shape, dtype=np.int64)
        for d in dims:
            above[:, d] = np.searchsorted(self.value[:, d], vectors[:, d])
        below = above - 1
        open_, exact = np.arange(n), 0
        for _ in range(self.count):
            x, up, down = vectors[open_], above[open_], below[open_]
            gap_up = np.where(up < self.count, self.value[np.minimum(up, self.count - 1), dims] - x, _FAR)
            gap_down = np.where(down >= 0, x - self.value[np.maximum(down, 0), dims], _FAR)
            rises = gap_up < gap_down
            frontier = np.where(rises, gap_up, gap_down)
            taken = self.number[np.where(rises, up, down), dims]
            above[open_] += rises
            below[open_] -= ~rises
            before = met[open_]
            now = before.copy()
            now[np.arange(len(open_))[:, None], taken] = True
            met[open_] = now
            for c in range(self.count):
                rows = open_[now[:, c] & ~before[:, c]]
                if not len(rows):
                    continue
                exact += len(rows)
                distance = ((vectors[rows] - self.centroids[c]) ** 2).sum(axis=1)
                wins = (distance < best[rows]) | ((distance == best[rows]) & (c < found[rows]))
                best[rows[wins]], found[rows[wins]] = distance[wins], c
            bound = (frontier**2).sum(axis=1)
            open_ = open_[(bound <= best[open_]) & ~now.all(axis=1)]
            if not len(open_):
                break
        return found, best, exact


def integer_rows(vectors: DataFrame, dimensions: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``v``: floor(scale x) of each component, of the vectors that take part.

    Others have a null vector, another length, a null or non-finite component, or one whose
    whole number is so large that squared distances would leave 64 bits.
    """
    x = F.transform(F.col(vector_column), lambda c: F.floor(c.cast("double") * scale))
    limit = largest_component(dimensions)
    x_ok = F.forall(vector_column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < limit))
    usable = F.col(vector_column).isNotNull() & (F.size(vector_column) == dimensions)
    return vectors.where(F.coalesce(usable & x_ok, F.lit(False))).select(
        F.col(id_column).alias("id"), x.cast("array<int>").alias("v")
    )


def largest_component(dimensions: int) -> int:
    """A power of two: squared distances of components below it stay below 2^62."""
    return 2 ** min(30, (60 - max(1, dimensions - 1).bit_length()) // 2)


def _matrix(batch: pa.RecordBatch, name: str, dimensions: int) -> np.ndarray:
    lists = batch.column(name)
    return lists.flatten().to_numpy().reshape(len(lists), dimensions).astype(np.int64)


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the ``k`` smallest hashes of seed and id; ties by the vector."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(hashed.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def moved_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: centroids at the floor of the mean of their vectors; empty ones stay."""
    dimensions = centroids.shape[1]
    sums = StructType().add("c", IntegerType()).add("d", IntegerType()).add("total", LongType())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(centroids)
        # The last column counts vectors.
        total = np.zeros((len(centroids), dimensions + 1), dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch, "v", dimensions)
            for a in range(0, len(vectors), BLOCK):
                part = vectors[a : a + BLOCK]
                found, _, _ = lists.nearest(part)
                for c in np.unique(found):
                    mine = part[found == c]
                    total[c, :-1] += mine.sum(axis=0)
                    total[c, -1] += len(mine)
        c, d = np.nonzero(total)
        columns = [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(total[c, d], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=sums.names)

    moved = rows.select("v").mapInArrow(add_up, sums)
    moved = moved.groupBy("c", "d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = [[0] * (dimensions + 1) for _ in centroids]
    for r in moved.collect():  # at most a number for each centroid and dimension
        total[r["c"]][r["d"]] = int(r["total"])
    new = centroids.copy()
    for c, sums_of in enumerate(total):
        if sums_of[-1]:
            new[c] = [s // sums_of[-1] for s in sums_of[:-1]]
    return new


def fit_centroids(rows: DataFrame, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds; once none moves, the rest would change nothing."""
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        new = moved_centroids(rows, centroids)
        if np.array_equal(new, centroids):
            break
        centroids = new
    return centroids


def assign_vectors(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of each row; no row changes its place, there is no shuffle."""
    dimensions = centroids.shape[1]
    schema = StructType().add(rows.schema["id"]).add("cluster", IntegerType()).add("distance", LongType())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(centroids)
        for batch in batches:
            vectors = _matrix(batch, "v", dimensions)
            parts = [lists.nearest(vectors[a : a + BLOCK])[:2] for a in range(0, len(vectors), BLOCK)]
            if not parts:
                continue
            found, distance = (np.concatenate(x) for x in zip(*parts, strict=True))
            columns = [batch.column("id"), pa.array(found, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("id", "v").mapInArrow(assign, schema)


def cluster_vectors(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``id, cluster, distance, centroid, centroid_sha256, cluster_inertia, inertia`` of every
    vector kept; the hash is that of the centroid's components as decimal numbers.

    Vectors that are null, of another length, with a null or non-finite component or one of
    ``largest_component`` and more after scaling take no part. Rows are vectors of their own,
    also those that share an id; a null id comes last among the first centroids. With fewer
    than ``k`` vectors there are as many centroids as vectors, and an empty table gives no
    rows. Equal distances go to the smaller number. Other columns take no part.
    """
    spark = vectors.sparkSession
    rows = stored(integer_rows(vectors, dimensions, scale, id_column, vector_column), "cluster-vectors")
    centroids = fit_centroids(rows, k, rounds, seed)
    known = StructType().add("cluster", IntegerType()).add("centroid", ArrayType(LongType()))
    known = known.add("centroid_sha256", StringType())
    known = known.add("cluster_inertia", LongType()).add("inertia", LongType())
    if not len(centroids):
        centroids = np.zeros((0, dimensions), dtype=np.int64)
    placed = stored(assign_vectors(rows, centroids), "cluster-assigned")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    each = {r["cluster"]: int(r["total"]) for r in sums}
    about = [(c, centroids[c].tolist(), centroid_digest(centroids[c].tolist()), total, sum(each.values())) for c, total in each.items()]
    # A row for each centroid at most.
    joined = placed.join(F.broadcast(spark.createDataFrame(about, known)), "cluster")
    return joined.select("id", "cluster", "distance", *known.names[1:])


def centroid_digest(centroid: list[int]) -> str:
    """Hash of a centroid's components as decimal numbers."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
