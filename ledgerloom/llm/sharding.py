"""Shards that all show the same mixture of sources: proportional stratified interleaving.

Every source is shuffled by a seeded hash and ranked. A row's place is its fractional rank,
(rank - 1/2) / rows of its source, so the rows of each source lie evenly over (0, 1). All
rows in the order of their places, cut into equal runs, are the shards.

No task sees a whole source. Both rankings, inside a source and over all rows, come from
counts of narrow buckets: prefix sums over the counts plus row numbers inside a bucket.
Buckets of the first ranking are ranges of the hash, buckets of the second are ranges of the
fractional rank; both hold about ``bucket_rows`` rows whatever the size of a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_names, small, stored

HASH_BITS = 30


def _row_numbers(rows: DataFrame, group: str, bucket: str, order: list, out: str) -> DataFrame:
    """Add ``out`` = 1, 2, ... over all rows of a ``group``, ordered by bucket, then ``order``.

    The window that orders whole groups only sees one row per bucket.
    """
    earlier = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(F.col(group).alias("_g"), F.col(bucket).alias("_b"))
        .agg(F.count("*").alias("_n"))
        .select("_g", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(group, bucket).orderBy(*order))
    same = (F.col(group) == F.col("_g")) & (F.col(bucket) == F.col("_b"))
    return (
        rows.withColumn("_inside", inside)
        .join(before, same)
        .withColumn(out, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_g", "_b", "_before", "_inside")
    )


def interleaved_shards(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 17,
    id_column: str = "doc_id",
    source_column: str = "source",
    tie_columns: list[str] | None = None,
    bucket_rows: int = 1024,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... inside the shard).

    Shards differ by one row at most, and in each of them every source has its share of all
    rows to within a few rows. The same rows get the same places on every run.

    Defined results: a null source is a source of its own; null ids are ordered like a value;
    rows that agree in id and ``tie_columns`` are interchangeable, and each gets a place; an
    empty table gives an empty table; other columns come through as they are, also where they
    are called ``shard`` or ``slot``: then the new columns end in an underscore. ``docs`` should
    be narrow (ids, sizes), since every row is shuffled twice.
    """
    shard_name, slot_name = free_names(docs, "shard", "slot")
    ties = [c for c in (tie_columns or []) if c != id_column]
    # Working names that the caller's columns cannot clash with.
    plain = docs.select(
        F.col(source_column).alias("_source"),
        F.col(id_column).alias("_id"),
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(ties)],
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
    )
    tie_names = ["_id", *[f"_t{i}" for i in range(len(ties))]]
    rows = stored(plain.withColumn("_hash", F.xxhash64(F.lit(seed), *tie_names)), "interleave")
    total = rows.count()
    numbered = Window.orderBy("_source")  # over one row for each source
    sizes = (
        rows.groupBy("_source")
        .agg(F.count("*").alias("_size"))
        .select(F.col("_source").alias("_name"), "_size", F.row_number().over(numbered).alias("_of"))
    )
    rows = rows.join(small(stored(sizes, "sizes")), F.col("_source").eqNullSafe(F.col("_name")))

    # First ranking: ranges of the hash, about bucket_rows rows of the source in each.
    unit = F.shiftrightunsigned("_hash", 64 - HASH_BITS)  # 0 to 2^HASH_BITS - 1
    buckets = F.ceil(F.col("_size") / bucket_rows)
    ties = [F.col(c) for c in tie_names]
    rows = rows.withColumn("_unit", unit).withColumn(
        "_bucket", F.shiftright(F.col("_unit") * buckets, HASH_BITS)
    )
    rows = _row_numbers(rows, "_of", "_bucket", ["_unit", "_hash", *ties], "_rank")

    # Second ranking: fractional ranks in (0, 1). Every source lies evenly over them, and so
    # do all rows together.
    buckets = -(-total // bucket_rows)
    place = (2 * F.col("_rank") - 1) / (2 * F.col("_size"))
    rows = rows.withColumn("_place", place).withColumn(
        "_bucket", F.least(F.floor(F.col("_place") * buckets), F.lit(buckets - 1).cast("bigint"))
    )
    rows = rows.withColumn("_all", F.lit(0))
    rows = _row_numbers(rows, "_all", "_bucket", ["_place", "_hash", "_of", *ties], "_at")

    cut = rows.withColumn("_cut", F.expr(f"(_at - 1) * {shards} div {max(total, 1)}"))
    start = F.expr(f"(_cut * {total} + {shards - 1}) div {shards}")  # first row of the shard
    return cut.select(
        "_row.*",
        F.col("_cut").cast("int").alias(shard_name),
        (F.col("_at") - 1 - start).cast("bigint").alias(slot_name),
    )
