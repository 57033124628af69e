"""Joins on keys that may hold a large share of all rows.

A shuffle join sends all rows of a key to one task. Spark splits such a task at run time
only where both join inputs come straight from an exchange, which they often do not. Here
the rows of a busy key are dealt to several slices, and the other side's rows of that key are
repeated for each slice. Which keys are busy is part of the plan: no job runs while it is
built, and a table without busy keys pays for one count by hash of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is busy if it holds more than this part of all rows: 1 / SHARES. So at most SHARES
# keys are busy, whatever the size of the data, and their list can be broadcast.
SHARES = 8192
# Rows are counted by this many hashes of the key before any key is counted itself.
BUCKETS = 32768


def rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.expr("count(*) AS _rows"))


def busy_keys(counts: DataFrame, keys: list[str], shares: int = SHARES) -> DataFrame:
    """``keys, _rows, _total`` of keys with more than 1 / ``shares`` of all rows.

    ``counts`` has one row per key, with its number of rows as ``_rows``.
    """
    total = counts.selectExpr("CAST(sum(_rows) AS DOUBLE)").scalar()
    found = counts.select(*keys, "_rows", total.alias("_total"))
    return found.where(f"CAST(_rows AS DOUBLE) * {shares} > _total")


def find_busy(df: DataFrame, keys: list[str], shares: int = SHARES) -> DataFrame:
    """``busy_keys`` of a table of rows, without a count per key.

    A busy key lies in a bucket of hashes with as large a share of the rows. Few buckets have
    one, and only keys of these are counted: a key that comes a few times is never shuffled.
    """
    bucket = f"pmod(xxhash64({', '.join(map(quoted, keys))}), {BUCKETS}) AS _bucket"
    buckets = df.selectExpr(bucket).groupBy("_bucket").agg(F.expr("count(*) AS _rows"))
    total = buckets.selectExpr("CAST(sum(_rows) AS DOUBLE)").scalar()
    full = buckets.where((F.col("_rows").cast("double") * shares > total)).select("_bucket")
    within = df.selectExpr(*map(quoted, keys), bucket).join(F.broadcast(full), "_bucket", "left_semi")
    found = rows_per_key(within, keys).select(*keys, "_rows", total.alias("_total"))
    return found.where(f"CAST(_rows AS DOUBLE) * {shares} > _total")


def join_busy(
    big: DataFrame,
    unique: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    shares: int = SHARES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``big.join(unique, keys, how)``, with busy keys dealt to as many slices as they have shares.

    ``unique`` has one row per key, or a few; at most two rows per share are added to it for
    each of these. ``spread`` names columns of ``big`` whose hash deals the rows: they should
    tell rows apart. Rows without a key find no partner and are dealt to all tasks. Busy keys
    are found in ``counted``, which may be ``big`` before costly steps, or in ``counts``: rows
    per key as ``rows_per_key`` gives them, where they are known.
    """
    if counts is not None:
        busy = busy_keys(counts, keys, shares)
    else:
        busy = find_busy(big if counted is None else counted, keys, shares)
    share = f"least(_rows, ceil(CAST(_rows AS DOUBLE) * {shares} / _total)) AS _slices"
    slices = F.broadcast(busy.selectExpr(*map(quoted, keys), share))
    dealt = f"xxhash64({', '.join(map(quoted, spread))})"
    no_key = " OR ".join(f"{quoted(c)} IS NULL" for c in keys)
    salt = (
        f"CASE WHEN {no_key} THEN pmod({dealt}, {shares})"
        f" WHEN _slices IS NOT NULL THEN pmod({dealt}, _slices) ELSE 0L END AS _slice"
    )
    every = "explode(sequence(0L, coalesce(_slices, 1L) - 1)) AS _slice"
    left = big.join(slices, keys, "left").selectExpr("* EXCEPT (_slices)", salt)
    right = unique.join(slices, keys, "left").selectExpr("* EXCEPT (_slices)", every)
    return left.join(right, [*keys, "_slice"], how).drop("_slice")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
