"""Row numbers are the same whether groups are numbered whole or from counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import numbering
from ledgerloom.functions.numbering import first_per_key, number_rows

SCHEMA = "k long, name string, price decimal(10,2), note string"
LEVELS = [["name"], ["price"]]


def rows(n: int, seed: int, names: int) -> list[dict]:
    rnd = random.Random(seed)
    return [
        {
            "k": rnd.choice([1, 1, 1, 2, 3, rnd.randrange(100)]),
            "name": rnd.choice([None, *(f"n{i}" for i in range(names))]),
            "price": None if rnd.random() < 0.1 else rnd.randrange(300) / 100,
            "note": rnd.choice([None, "a", "b"]),
        }
        for _ in range(n)
    ]


def result(df):
    return sorted(df.collect(), key=lambda r: (r["k"], r["line"]))


def from_floats(frame, data):
    df = frame(SCHEMA.replace("decimal(10,2)", "double"), *data)
    return df.withColumn("price", F.col("price").cast("decimal(10,2)"))


@pytest.mark.parametrize("names,shares", [(1, 10**6), (4, 10**6), (40, 25), (4, 3), (400, 60)])
def test_large_groups_get_the_same_numbers(frame, names, shares):
    df = from_floats(frame, rows(500, names, names))
    whole = number_rows(df, ["k"], LEVELS, "line", shares=1, first="first")
    split = number_rows(df, ["k"], LEVELS, "line", shares=shares, first="first")
    assert result(whole) == result(split)
    assert whole.columns == split.columns
    seen = df.groupBy("k").agg(F.count_distinct(F.coalesce("name", F.lit("")))).collect()
    firsts = split.groupBy("k").agg(F.count_if("first")).collect()
    assert sorted(map(tuple, seen)) == sorted(map(tuple, firsts))


def test_numbers_follow_the_order_of_plain_python(frame):
    data = rows(400, 3, 12)
    got = result(number_rows(from_floats(frame, data), ["k"], LEVELS, "line", shares=100))
    def place(r):
        return [(r[c] is not None, r[c]) for c in ("name", "price", "note")]
    want = []
    for k in sorted({r["k"] for r in data}):
        mine = sorted((r for r in data if r["k"] == k), key=place)
        want += [(k, r["name"], r["note"], n) for n, r in enumerate(mine, 1)]
    assert [(r["k"], r["name"], r["note"], r["line"]) for r in got] == want


def test_null_group_is_split_too(frame):
    data = [{"k": None, "name": f"n{i:03}"} for i in range(200)] + [{"k": 1, "name": "a"}]
    df = from_floats(frame, data)
    split = number_rows(df, ["k"], LEVELS, "line", shares=20).where("k IS NULL").orderBy("line").collect()
    assert [r["name"] for r in split] == [f"n{i:03}" for i in range(200)]
    assert [r["line"] for r in split] == list(range(1, 201))


def test_group_of_distinct_names_falls_into_even_ranges(spark):
    """A third of all rows are one order, each line with a name of its own."""
    n, shares = 30_000, 64
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.format_string("name %05d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("name"),
    )
    cut = numbering._Cut(df, ["k"], [["name"]], shares)
    assert [r["_k0"] for r in cut.large.collect()] == [-1]
    sizes = [r["count"] for r in cut.ranged(df, cut.borders()).groupBy("_range").count().collect()]
    assert len(sizes) > shares / 3 / 2 and max(sizes) < 8 * n / shares
    numbered = number_rows(df, ["k"], [["name"]], "line", shares=shares)
    top = numbered.where("k = -1").agg(F.max("line"), F.count_distinct("line")).first()
    assert tuple(top) == (n // 3, n // 3)


def test_borders_are_found_in_two_steps(frame, monkeypatch):
    monkeypatch.setattr(numbering, "STRIDE", 3)
    df = from_floats(frame, rows(500, 5, 60))
    whole = number_rows(df, ["k"], LEVELS, "line", shares=1, first="first")
    split = number_rows(df, ["k"], LEVELS, "line", shares=200, first="first")
    assert result(whole) == result(split)


def test_numbers_are_dense(frame):
    df = from_floats(frame, rows(300, 7, 3))
    per_key = number_rows(df, ["k"], LEVELS, "line", shares=30).groupBy("k").agg(
        F.count("*").alias("n"), F.min("line").alias("a"), F.max("line").alias("b"),
        F.count_distinct("line").alias("d"),
    )
    assert all(r["a"] == 1 and r["b"] == r["n"] == r["d"] for r in per_key.collect())


def test_many_copies_of_one_row_are_sliced(frame, monkeypatch):
    monkeypatch.setattr(numbering, "COPIES_PER_ROW", 10)
    df = frame(SCHEMA, *[{"k": 1, "name": "same"}] * 95, {"k": 1, "name": "z"}, {"k": 2, "name": "b"})
    got = result(number_rows(df, ["k"], LEVELS, "line", shares=5, first="first"))
    assert [r["line"] for r in got] == [*range(1, 97), 1]
    assert got[95]["name"] == "z"
    assert [r["line"] for r in got if r["first"]] == [1, 96, 1]


def test_every_window_is_cut_by_a_range_or_has_small_groups(frame):
    df = from_floats(frame, rows(200, 3, 5))
    plan = number_rows(df, ["k"], LEVELS, "line")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(k" in line]
    assert len(windows) >= 2
    # Whole groups only after the anti join with the busy ones; counts per range; rows per range.
    assert "LeftAnti" in plan and any("_range" in line for line in windows)


def test_first_per_key_cuts_groups_before_the_exchange(frame):
    df = from_floats(frame, rows(50, 5, 3))
    first = first_per_key(df, ["k"], ["name", "price", "note"])
    assert first.count() == df.select("k").distinct().count()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
