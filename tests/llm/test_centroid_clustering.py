"""Clusters against plain rounds of assigning and moving."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from compare import differences
from ledgerloom.llm import queries
from ledgerloom.llm.centroid_clustering import SortedCentroids, cluster_vectors, largest_component

SCHEMA = "vec_id bigint, embedding array<float>"


def plain_nearest(v: list[int], centroids: list[list[int]]) -> tuple[int, int]:
    return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))


def plain_clusters(rows: list[tuple], k: int, rounds: int, dims: int, scale: int, seed: int) -> list[tuple]:
    kept = []
    for i, v in rows:
        if v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        if max(map(abs, v)) * scale >= largest_component(dims):
            continue
        kept.append((i, [math.floor(float(np.float32(x)) * scale) for x in v]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in first[:k]]
    for _ in range(rounds):
        mine: dict[int, list] = {}
        for _, v in kept:
            mine.setdefault(plain_nearest(v, centroids)[1], []).append(v)
        for c, vectors in mine.items():
            centroids[c] = [sum(x) // len(vectors) for x in zip(*vectors, strict=True)]
    placed = [(i, *plain_nearest(v, centroids)) for i, v in kept]
    each = {c: sum(d for _, d, n in placed if n == c) for c in range(len(centroids))}
    return sorted(
        ((i, c, d, tuple(centroids[c]), each[c], sum(each.values())) for i, d, c in placed),
        key=lambda r: (r[0] is None, r),
    )


def clusters(df, **options) -> list[tuple]:
    got = cluster_vectors(df, **options)
    assert got.columns == ["id", "cluster", "distance", "centroid", "centroid_sha256", "cluster_inertia", "inertia"]
    rows = got.collect()
    for r in rows:
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest()
    found = [(r["id"], r["cluster"], r["distance"], tuple(r["centroid"]), r["cluster_inertia"], r["inertia"]) for r in rows]
    return sorted(found, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize(("k", "dims", "high"), [(8, 64, 600), (8, 3, 5), (5, 2, 9), (1, 4, 3), (7, 1, 40), (8, 64, 2**27)])
def test_threshold_algorithm_finds_the_nearest(k, dims, high):
    rng = np.random.default_rng(dims + k)
    centroids = rng.integers(-high, high, (k, dims))
    centroids[-1] = centroids[0]  # a tie with the smaller number
    vectors = np.vstack([rng.integers(-high, high, (700, dims)), centroids])
    found, distance, exact = SortedCentroids(centroids).nearest(vectors)
    all_ = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (found == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
    assert exact <= all_.size


def test_threshold_algorithm_stops_early():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-1000, 1000, (64, 2))
    vectors = centroids[rng.integers(0, 64, 5000)] + rng.integers(-5, 6, (5000, 2))
    _, _, exact = SortedCentroids(centroids).nearest(vectors)
    assert exact < 0.2 * 64 * 5000


def odd_rows(dims: int) -> list[tuple]:
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(60)]
    hot = rows[3][1]
    rows += [(100 + i, hot) for i in range(40)] + [(7, rows[7][1])] * 2 + [(None, rows[2][1]), (None, rows[4][1])]
    rows += [(200, None), (201, []), (202, [1.0] * (dims - 1)), (203, [None] + [0.5] * (dims - 1))]
    rows += [(204, [float("nan")] + [0.5] * (dims - 1)), (205, [float("-inf")] + [0.5] * (dims - 1))]
    return rows + [(206, [1e30] + [0.5] * (dims - 1)), (None, None), (207, [-0.0] * dims), (207, [0.0] * dims)]


@pytest.mark.parametrize("k", [1, 3, 8])
def test_odd_rows(spark, k):
    rows = odd_rows(6)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS cluster").repartition(5)
    options = dict(k=k, rounds=4, dimensions=6, scale=64)
    assert clusters(df, **options) == plain_clusters(rows, k, 4, 6, 64, 3)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(5, [1.0, 2.0]), (6, [3.0, -1.0]), (6, [3.0, -1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert clusters(df, dimensions=2) == plain_clusters(rows, 8, 10, 2, 1024, 3)
    assert clusters(df.limit(0), dimensions=2) == []
    assert clusters(df, dimensions=3) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.op13_centroids(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert differences(got, con, queries.SQL["op13_centroids"]) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = plain_clusters(rows, 8, 10, 64, 1024, 3)
    assert sorted((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"]) for r in got.collect()) == [
        (*r[:3], *r[4:]) for r in want
    ]
