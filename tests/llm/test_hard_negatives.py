"""Hard negatives against all scores, and the parts that choose blocks."""

from __future__ import annotations

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences
from ledgerloom.llm import hard_negatives as H
from ledgerloom.llm import queries

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def plain(rows: list[tuple], every: int, positives: int, negatives: int, low: int, high: int, scale: int) -> list[tuple]:
    usable = []
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(float(np.float32(x)) * scale) for x in v]
        if max(abs(float(x)) * scale for x in v) < 2**30 and sum(x * x for x in whole) < 2**53:
            usable.append((i, label, whole))
    asking = {}
    for i, label, v in sorted(usable):
        if i % every == 0:
            asking.setdefault(i, (label, v))
    out = []
    for a, (label, v) in asking.items():
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, other, w in usable if len(w) == len(v)
        )
        best = [(i, -s) for s, i, alike in scored if alike and i != a][:positives]
        for i, p in best:
            hard = [(j, -s) for s, j, alike in scored if not alike and low * p <= -100 * s <= high * p][:negatives]
            out += [(a, i, rank, j, p, n) for rank, (j, n) in enumerate(hard, 1)]
    return sorted(out)


def mined(df, **options) -> list[tuple]:
    got = H.hard_negatives(df, F.col("id") % options.pop("every", 10) == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def clustered(n: int, dims: int, seed: int = 4) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(size=dims) * 0.3
        rows.append((i, int(rng.integers(4)), v.astype(np.float32).tolist()))
    return rows


def test_hilbert_keys_walk_to_neighbours():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = H.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(3)
    anchors, vectors = rng.integers(-90, 90, (20, 7)), rng.integers(-90, 90, (50, 7))
    asks = H.pa.StructArray.from_arrays([H.pa.array([0], H.pa.int32()), H.pa.array([0]), H.pa.array([1])], names=["at", "low", "high"])
    row = {"ids": np.arange(20), "row_labels": np.zeros(20, dtype=np.int64), "vectors": anchors.astype(np.int32).tobytes(), "asks": asks}
    least, greatest = H.Group(row, 1, True).bounds(vectors.min(axis=0), vectors.max(axis=0))
    scores = anchors @ vectors.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (greatest[:, 0] >= scores.max(axis=1)).all()


def test_small_blocks_groups_and_pages(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGE_BLOCKS", 3)
    monkeypatch.setattr(H, "SLICE_BLOCKS", 2)
    monkeypatch.setattr(H, "CHUNK", 4)
    rows = clustered(700, 8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = plain(rows, 10, 5, 5, 80, 100, 64)
    assert len(want) > 500
    assert mined(df, scale=64, block_rows=16, group_rows=9) == want
    want = plain(rows, 10, 2, 3, -50, 120, 64)
    assert mined(df, scale=64, block_rows=50, group_rows=40, positives=2, negatives=3, lower_percent=-50, upper_percent=120) == want


def test_zone_maps_spare_blocks(spark):
    rows = [(i, label, [x * 10 for x in v]) for i, label, v in clustered(3000, 6, 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    keyed = H.in_curve_order(H.integer_rows(df, "vec_id", "label", "embedding", 64)).cache()
    blocks = H.packed(keyed, 32).cache()
    groups = H.packed(keyed.where("id % 100 = 0"), 1).withColumnRenamed("number", "group")
    top = 64 * 64 * 100
    asks = F.array(F.struct(F.lit(0).alias("at"), F.lit(8 * top).cast("bigint").alias("low"), F.lit(2**60).alias("high")))
    groups = groups.withColumn("asks", H._asks(asks))
    chosen = H.chosen_blocks(groups, H.zone_pages(blocks), True).count()
    assert 0 < chosen < 0.5 * groups.count() * blocks.count()


def odd_rows(dims: int) -> list[tuple]:
    rows = clustered(120, dims, 6)
    hot = rows[10][2]
    rows += [(1000 + i, i % 3, hot) for i in range(150)]  # more than half of all vectors are alike
    rows += [rows[20], rows[20], (30, 3, rows[31][2]), (30, 0, rows[31][2]), (40, 1, rows[50][2])]
    rows += [(None, 1, hot), (310, None, hot), (320, 1, None), (330, 1, []), (340, 1, [None] * dims), (None, None, None)]
    rows += [(350, 1, [float("nan")] * dims), (360, 2, [float("inf")] + [0.0] * (dims - 1)), (370, 1, [1e30] * dims)]
    rows += [(380, 1, [4e5] * dims), (390, 1, [-4e5] * dims), (391, 2, [4e5] * dims), (392, 1, [3.9e5] * dims)]
    rows += [(400, 2, [1.0, 2.0]), (401, 2, [3.0, 1.0]), (402, 1, [2.0, 1.5]), (410, 2, [-1.0, 0.5]), (420, 77, hot)]
    return rows + [(430, 5, [0.0] * dims), (431, 5, [-0.0] * dims), (432, 6, [0.0] * dims)]


def test_odd_rows(spark):
    rows = odd_rows(6)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS key", "4 AS number").repartition(4)
    want = plain(rows, 10, 5, 5, 80, 100, 32)
    assert mined(df, scale=32) == want
    assert mined(df, scale=32, block_rows=7, group_rows=5) == want
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id = 400")) == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = queries.op12_hard_negatives(spark, folder)
    assert differences(got, con, queries.SQL["op12_hard_negatives"]) == []
