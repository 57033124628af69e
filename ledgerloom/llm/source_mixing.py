"""Sources mixed to target weights, by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / source size. Its
whole part is taken; its fraction is rounded so that the words of the source come out at the
target. For that, two fractional documents meet and mass (words) moves from one to the other
in a random direction until one of them is decided, taken or not. Their words together stay
the same, and every document keeps its expected value. One undecided document is left.

Repeated rows are one document here: of rows * rate copies the whole part is settled, and
only what is left, less than one copy of one row, is rounded.

This is done in a tree. Documents of a source are dealt by hash to groups of bounded size, each
of which decides all its documents but one; those meet at the next level. A source that fits
into one group is decided there, along with other such sources. Its last document goes to the
nearer side, so that the words taken differ from the target by half a document at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_names, small, stored, text_of

GROUP_ROWS = 4096
_TINY = 1e-12


def word_count(text: str = "text") -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with ``target``.

    Sources by code point, null last, weigh ``weights`` over and over. Together they get
    ``share`` times all sizes by weight, none more than ``most`` times its own; what is cut is
    shared out again by weight. That is one water level: target = min(most x size, level x
    weight), found by prefix sums over the sources in the order of size / weight.
    """
    if share > most:
        raise ValueError("the sources can't hold the share")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    full = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("_weight", weight).withColumn("_full", full).withColumn("_ratio", full / F.col("_weight"))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (wanted - F.coalesce(F.sum("_full").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    rows = rows.withColumn("_level", level)
    free = F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))
    rows = rows.withColumn("_water", F.first(free, ignorenulls=True).over(whole))
    target = F.least(F.col("_full"), F.coalesce(F.col("_water") * F.col("_weight"), F.col("_full")))
    return rows.select("source", "source_size", target.alias("target"))


def pivotal(p: list[float], mass: list[float], draws: list[float]) -> tuple[list[int], int, float]:
    """Round fractions one pair at a time; ``sum(p * mass)`` stays as it is.

    Returns 0 or 1 for each (-1: undecided), the index of the undecided one (or -1) and its
    fraction. Nothing is random but ``draws``, one for each.
    """
    out = [0] * len(p)
    at, left = -1, 0.0
    for i, (q, m, draw) in enumerate(zip(p, mass, draws, strict=True)):
        if q <= _TINY or m <= 0:
            continue
        if q >= 1 - _TINY:
            out[i] = 1
            continue
        if at < 0:
            at, left = i, q
            continue
        n = mass[at]
        up = min((1 - left) * n, q * m)  # words that may move to the waiting one
        down = min(left * n, (1 - q) * m)
        if draw * (up + down) < down:
            left, q = left + up / n, q - up / m
        else:
            left, q = left - down / n, q + down / m
        if _TINY < q < 1 - _TINY:  # the waiting one is decided
            out[at] = int(left > 0.5)
            at, left = i, q
        else:
            out[i] = int(q > 0.5)
            if not _TINY < left < 1 - _TINY:
                out[at] = int(left > 0.5)
                at = -1
    if at >= 0:
        out[at] = -1
    return out, at, left


_STATE = "_of bigint, _unit bigint, _mass double, _p double, _extra int, _group bigint, _last boolean, _key string"


def _reduce(seed: int, level: int):
    """One level: a group of undecided documents becomes at most one of each source, and none
    of a source that is here as a whole."""

    def decide(part: pd.DataFrame) -> pd.DataFrame:
        # A fixed order and draws that depend on the group alone: a repeated task agrees.
        # Large documents come first, so that the one left undecided is likely a small one.
        order = ["_of", "_mass", "_unit", "_key"]
        part = part.sort_values(order, ascending=[True, False, True, True], kind="stable", ignore_index=True)
        draws = np.random.default_rng([seed, level, int(part["_group"].iloc[0])]).random(len(part))
        extra, p = part["_extra"].to_numpy().copy(), part["_p"].to_numpy().copy()
        mass, of, last = part["_mass"].to_numpy(), part["_of"].to_numpy(), part["_last"].to_numpy()
        edges = np.flatnonzero(np.diff(of)) + 1
        for a, b in zip([0, *edges], [*edges, len(part)], strict=True):
            got, at, left = pivotal(p[a:b].tolist(), mass[a:b].tolist(), draws[a:b].tolist())
            extra[a:b] = got
            if at >= 0:
                p[a + at] = left
                if last[a]:
                    extra[a + at] = int(left >= 0.5)
        part["_extra"], part["_p"] = extra, p
        return part

    return decide


def mix_sources(docs: DataFrame, *args, **settings) -> DataFrame:
    """What the mix takes of each document; the settings are those of ``_taken``.

    One row per distinct (id, source, size, text) and number of copies: ``doc_id``, ``source``,
    ``size``, ``text_hash`` (of the text; null has one of its own), ``rows`` (how many such rows
    of ``docs`` get so many copies), ``source_size``, ``target`` and ``copies`` (0 to ``most``)
    of each such row.

    Defined results: null and blank texts have size 0 and count for nothing, they get the
    whole part of their source's rate; a null source is a source; null ids are told apart by
    their texts; copies of repeated rows differ by one at most; an empty table gives an empty
    table. The same rows give the same mix on every run.
    """
    taken = _taken(docs, *args, **settings)
    some = F.struct((F.col("rows") - F.col("_more")).alias("rows"), F.col("_each").alias("copies"))
    others = F.struct(F.col("_more").alias("rows"), (F.col("_each") + 1).alias("copies"))
    parts = F.explode(F.filter(F.array(some, others), lambda x: x.rows > 0)).alias("_part")
    units = ["doc_id", "source", "size", "text_hash"]
    return taken.select(*units, "source_size", "target", parts).select(
        *units, F.col("_part.rows").alias("rows"), "source_size", "target", F.col("_part.copies").cast("int").alias("copies")
    )


def _taken(
    docs: DataFrame,
    size: Column | None = None,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 11,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per distinct (id, source, size, text): of its ``rows`` each gets ``_each``
    copies, and ``_more`` of them get one more."""
    sizes = word_count(text_column) if size is None else size
    units = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        sizes.alias("size"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
    )
    units = stored(units.groupBy(*units.columns).agg(F.count("*").alias("rows")), "mix-units")

    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = source_targets(stored(totals, "mix-totals"), weights, share, most)
    numbered = targets.withColumn("_of", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    numbered = small(stored(numbered.withColumnRenamed("source", "_source"), "mix-targets"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    rated = units.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).select(
        *units.columns,
        "source_size",
        "target",
        F.col("_of").cast("bigint").alias("_of"),
        F.coalesce(rate, F.lit(0.0)).alias("_rate"),
        F.xxhash64("doc_id", "text_hash", F.lit(seed)).alias("_unit"),
        F.concat_ws(":", "doc_id", "text_hash", "size").alias("_key"),
    )
    # A document of size 0 moves no words: its rows get the whole part of the rate.
    expected = F.col("rows") * F.when(F.col("size") > 0, F.col("_rate")).otherwise(F.floor("_rate"))
    rated = rated.withColumn("_expected", expected).withColumn("_whole", F.floor("_expected"))
    state = rated.select(
        "_of",
        "_unit",
        F.col("size").cast("double").alias("_mass"),
        (F.col("_expected") - F.col("_whole")).alias("_p"),
        F.lit(-1).alias("_extra"),
        F.lit(0).cast("bigint").alias("_group"),
        F.lit(False).alias("_last"),
        "_key",
    )
    done, level = [], 0
    while True:
        dealt = _dealt(state, level, group_rows)
        state = stored(dealt.groupBy("_group").applyInPandas(_reduce(seed, level), _STATE), "mix-level")
        done.append(state.where("_extra >= 0"))
        state, level = state.where("_extra < 0"), level + 1
        if state.isEmpty():
            break
    decided = done[0]
    for more in done[1:]:
        decided = decided.unionByName(more)
    decided = decided.select(*[F.col(c).alias(f"{c}_d") for c in ("_unit", "_of", "_key", "_extra")])
    same = (F.col("_unit") == F.col("_unit_d")) & (F.col("_of") == F.col("_of_d")) & (F.col("_key") == F.col("_key_d"))
    total = (F.col("_whole") + F.col("_extra_d")).cast("bigint").alias("_total")
    return rated.join(decided, same).select(*units.columns, "source_size", "target", total).select(
        "*", F.expr("_total div rows").alias("_each"), (F.col("_total") % F.col("rows")).alias("_more")
    )


def _dealt(state: DataFrame, level: int, group_rows: int) -> DataFrame:
    """``state`` in groups of about ``group_rows``: parts of one large source, or several
    sources that are small enough to be decided as a whole."""
    counts = state.groupBy(F.col("_of").alias("_source")).agg(F.count("*").alias("_n"))
    counts = stored(counts, "mix-counts")
    groups = max(1, -(-(counts.agg(F.sum("_n")).first()[0] or 0) // group_rows))
    fits = F.col("_n") <= group_rows
    part = F.pmod(F.xxhash64("_unit", F.lit(level)), F.ceil(F.col("_n") / group_rows))
    group = F.when(fits, F.xxhash64(F.lit(-1), F.pmod(F.xxhash64("_of"), F.lit(groups)))).otherwise(F.xxhash64("_of", part))
    met = state.join(small(counts), F.col("_of") == F.col("_source"))
    names = [f.split()[0] for f in _STATE.split(", ")]
    return met.withColumn("_group", F.shiftrightunsigned(group, 1)).withColumn("_last", fits).select(*names)


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    **settings,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    taken = _taken(docs, id_column=id_column, source_column=source_column, text_column=text_column, **settings)
    taken = stored(taken.where("_each > 0 or _more > 0"), "mix-taken")
    names = free_names(docs, "_id", "_source", "_hash", "_copies", "_extra")
    i, s, h, n, m = names
    columns = ("doc_id", "source", "text_hash", "_each", "_more")
    taken = taken.select(*[F.col(a).alias(b) for a, b in zip(columns, names, strict=True)])
    hash_name, again, row, part, before = free_names(
        docs.select("*", *[F.lit(0).alias(x) for x in names]), "_text_hash", "_again", "_row", "_part", "_before"
    )
    hashed = docs.withColumn(hash_name, F.xxhash64(F.col(text_column)))
    same = (
        (F.col(hash_name) == F.col(h))
        & F.col(id_column).eqNullSafe(F.col(i))
        & F.col(source_column).eqNullSafe(F.col(s))
    )
    even = hashed.join(taken.where(F.col(m) == 0), same).select(*docs.columns, n)
    uneven = taken.where(F.col(m) > 0)
    if not uneven.isEmpty():
        # Repeated rows are numbered within the parts of a stored table, after those of earlier parts.
        rows = hashed.join(small(uneven), same).withColumn(row, F.monotonically_increasing_id())
        rows = stored(rows.withColumn(part, F.shiftright(row, 33)), "mix-repeated")
        unit = [i, s, h]
        earlier = Window.partitionBy(*unit).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy(*unit, part).agg(F.count("*").alias("_rows"))
        counts = counts.withColumn(before, F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
        numbers = rows.withColumn(again, F.row_number().over(Window.partitionBy(*unit, part).orderBy(row)))
        l, r = numbers.alias("l"), counts.alias("r")
        met = l.join(r, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*unit, part]])
        more = (F.col(f"l.{again}") + F.col(f"r.{before}") <= F.col(f"l.{m}")).cast("bigint")
        even = even.unionByName(
            met.select(*[F.col(f"l.`{c}`") for c in docs.columns], (F.col(f"l.{n}") + more).alias(n)).where(F.col(n) > 0)
        )
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))).alias(again)
    return even.select(*docs.columns, repeated).drop(again)
