"""Exact membership of URL keys in a list, by cascades of Bloom filters.

The keys of a corpus are known, so the errors of a Bloom filter are known too. Level 1 holds
the listed keys. Level 2 holds the unlisted keys of the corpus that level 1 lets through by
mistake, level 3 the listed keys that level 2 lets through, and so on until a level lets
nothing through. A key of the corpus is listed if the first level that rejects it is an even
one, and no answer is ever wrong.

Keys are dealt by hash to shards of about ``keys_per_shard`` distinct keys, and each shard
has a cascade of its own, so that building one is a task of bounded size. All cascades
together are broadcast if they are small; larger ones meet the keys in a shuffle by shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.common import free_names, small, stored

BITS_PER_KEY = 10
HASHES = 7
MAX_LEVELS = 60
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    return F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as an index into ``rules``, or null.

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains where the
    path starts with the rule's. Of rules of one length the first wins.
    """
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    found = F.lit(None).cast("int")
    for i in reversed(order):
        _, of, start = rules[i]
        same = (host == of) | F.endswith(host, F.lit(f".{of}"))
        found = F.when(same & F.startswith(path, F.lit(start)), F.lit(i)).otherwise(found)
    return found


def _bits(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit positions of each key at a level, keys by hashes."""
    with np.errstate(over="ignore"):
        step = (h2 ^ (h1 >> np.uint64(29))) * _A | np.uint64(1)
        at = (h1 + np.uint64(level) * _B) ^ (h2 >> np.uint64(31))
        out = np.empty((len(h1), HASHES), dtype=np.uint64)
        for i in range(HASHES):
            mixed = at * _B
            out[:, i] = (mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)
            at = at + step
    return out


def _let_through(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    at = _bits(h1, h2, level, len(bits) * 8)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[bytes]:
    """The levels over distinct keys, given as pairs of 64-bit hashes."""
    inside = np.flatnonzero(listed)  # what the next level must let through
    outside = np.flatnonzero(~listed)
    levels: list[bytes] = []
    while len(inside):
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys agree in all 128 bits of their hashes")
        bits = np.zeros(-(-max(64, len(inside) * BITS_PER_KEY) // 8), dtype=np.uint8)
        at = _bits(h1[inside], h2[inside], len(levels), len(bits) * 8).ravel()
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        wrong = outside[_let_through(bits, h1[outside], h2[outside], len(levels))]
        levels.append(bits.tobytes())
        inside, outside = wrong, inside
    return levels


def in_cascade(levels: list[bytes], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys are listed. Exact for the keys that the cascade was built over."""
    found = np.zeros(len(h1), dtype=bool)
    left = np.arange(len(h1))
    for k, level in enumerate(levels):
        through = _let_through(np.frombuffer(level, dtype=np.uint8), h1[left], h2[left], k)
        found[left[~through]] = k % 2 == 1
        left = left[through]
    found[left] = len(levels) % 2 == 1
    return found


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(71), F.reverse(key))


def cascades(keys: DataFrame, keys_per_shard: int = 1 << 19) -> tuple[DataFrame, int]:
    """Cascades over ``keys`` (key, listed), one row per shard, and the number of shards.

    A key may come on many rows; it is listed if one of them says so. Null keys have no part.
    """
    h1, h2 = _hashes(F.col("key"))
    universe = stored(
        keys.where("key is not null")
        .groupBy("key")
        .agg(F.max(F.coalesce(F.col("listed"), F.lit(False))).alias("listed"))
        .select(h1.alias("h1"), h2.alias("h2"), "listed"),
        "url-keys",
    )
    shards = max(1, -(-universe.count() // keys_per_shard))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that a repeated task makes the same bytes.
        part = part.sort_values(["h1", "h2"])
        one, two = (part[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        levels = build_cascade(one, two, part["listed"].to_numpy(dtype=bool))
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "levels": [levels]})

    built = (
        universe.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, levels array<binary>")
    )
    return stored(built, "url-cascades"), shards


def flag_listed(
    rows: DataFrame,
    key: str,
    keys: DataFrame,
    out: str = "listed",
    keys_per_shard: int = 1 << 19,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``rows`` with ``out``: whether the list holds their key. Exact for all keys of ``keys``.

    ``keys`` (key, listed) is the complete universe: every key that ``rows`` may ask for.
    Null keys are not listed. ``rows`` keep their order and columns, without a join as long
    as all cascades together take ``broadcast_bytes`` at most; beyond that each row meets the
    cascade of its shard in a shuffle, where Spark splits hot shards.
    """
    built, shards = cascades(keys, keys_per_shard)
    size = built.select(F.sum(F.aggregate("levels", F.lit(0).cast("bigint"), lambda n, b: n + F.octet_length(b)))).first()[0]
    a, b, s = free_names(rows, "_h1", "_h2", "_shard")
    h1, h2 = _hashes(F.col(key))
    hashed = rows.withColumns({a: h1, b: h2}).withColumn(s, F.pmod(F.col(a), F.lit(shards)).cast("int"))
    if (size or 0) <= broadcast_bytes:
        flagged = _by_broadcast(hashed, built, s, a, b, out)
    else:
        flagged = _by_shard(hashed, built, s, a, b, out)
    return flagged.withColumn(out, F.col(out) & F.col(key).isNotNull()).drop(a, b, s)


def _by_broadcast(hashed: DataFrame, built: DataFrame, s: str, a: str, b: str, out: str) -> DataFrame:
    levels = {r["shard"]: [bytes(x) for x in r["levels"]] for r in built.collect()}
    held = hashed.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def listed(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for shard, one, two in parts:
            shard, one, two = shard.to_numpy(), one.to_numpy().view(np.uint64), two.to_numpy().view(np.uint64)
            found = np.zeros(len(one), dtype=bool)
            for k in np.unique(shard):
                at = np.flatnonzero(shard == k)
                found[at] = in_cascade(held.value.get(k, []), one[at], two[at])
            yield pd.Series(found)

    return hashed.withColumn(out, listed(s, a, b))


def _by_shard(
    hashed: DataFrame, built: DataFrame, s: str, a: str, b: str, out: str, rows_per_task: int = 200_000
) -> DataFrame:
    """Rows and cascades meet by shard and slice, a slice for each ``rows_per_task`` rows."""
    kept = stored(hashed, "url-rows").withColumn("_row", F.monotonically_increasing_id())
    slices = kept.groupBy(F.col(s).alias("_s")).agg(F.ceil(F.count("*") / rows_per_task).alias("_slices"))
    slices = stored(slices, "url-slices")
    sliced = kept.join(small(slices), F.col(s) == F.col("_s"))
    sliced = sliced.withColumn("_slice", F.pmod(F.col("_row"), F.col("_slices"))).drop("_row", "_slices", "_s")
    copies = built.join(slices, F.col("shard") == F.col("_s")).select(
        F.col("shard").alias(s), "levels", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice")
    )
    schema = StructType(list(hashed.schema.fields)).add(out, "boolean")

    def listed(part: pd.DataFrame, cascade: pd.DataFrame) -> pd.DataFrame:
        one, two = (part[c].to_numpy().view(np.uint64) for c in (a, b))
        levels = [bytes(x) for x in cascade["levels"].iloc[0]] if len(cascade) else []
        part[out] = in_cascade(levels, one, two)
        return part[schema.names]

    by = [s, "_slice"]
    return sliced.groupBy(*by).cogroup(copies.groupBy(*by)).applyInPandas(listed, schema)


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    listed: DataFrame | None = None,
    url_column: str = "url",
    keys_per_shard: int = 1 << 19,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    ``rules`` are (verdict, host, path). The list of blocked keys (host followed by path) is
    what the rules block among the keys of the corpus, and ``listed`` (column ``key``), if
    given, for keys without a rule. Every verdict comes from the cascades: a key is blocked
    if it is listed. So a url that no rule fits and no list names is allowed.

    Null urls and urls without ``://`` have an empty host and path. Columns of ``pages`` come
    first; those called like a new column are replaced. Repeated rows are all judged.
    """
    new = ["host", "path", "rule", "verdict"]
    kept = [c for c in pages.columns if c.lower() not in new]
    key, at, hit, h, p = free_names(pages, "_key", "_rule", "_listed", "_host", "_path")
    parsed = pages.select(*kept, *([url_column] if url_column not in kept else []))
    parsed = parsed.withColumns({h: host_of(url_column), p: path_of(url_column)})
    parsed = parsed.withColumns({key: F.concat(h, p), at: rule_of(F.col(h), F.col(p), rules)})
    names = F.array(*[F.lit(host + path) for _, host, path in rules])
    blocks = F.array(*[F.lit(verdict == "block") for verdict, _, _ in rules])
    by_rule = F.when(F.col(at).isNotNull(), F.get(blocks, F.col(at)))
    universe = parsed.select(F.col(key).alias("key"), by_rule.alias("ruled"), F.lit(False).alias("named"))
    if listed is not None:
        universe = universe.unionByName(
            listed.select("key", F.lit(None).cast("boolean").alias("ruled"), F.lit(True).alias("named"))
        )
    # The rule depends on the key alone, and outranks the list.
    universe = universe.groupBy("key").agg(F.max("ruled").alias("ruled"), F.max("named").alias("named"))
    universe = universe.select("key", F.coalesce("ruled", "named").alias("listed"))
    judged = flag_listed(parsed, key, universe, hit, keys_per_shard, broadcast_bytes)
    return judged.select(
        *kept,
        F.col(h).alias("host"),
        F.col(p).alias("path"),
        F.when(F.col(at).isNotNull(), F.get(names, F.col(at))).alias("rule"),
        F.when(F.col(hit), "block").otherwise("allow").alias("verdict"),
    )
