"""Similarity join of documents by word shingles, with token-combination prefixes.

Documents link when their sets of five-word shingles have a Jaccard similarity of at least
``percent`` / 100. The join is exact:

1. Documents with equal sets are one class; only classes are compared.
2. Shingles (tokens) are ordered, rare ones first, frequent ones last, by hash within. A set
   of n tokens lacks at most t = n - ceil(n percent / 100) tokens of a similar one. If it has
   more than t rare tokens, the first t + 1 of them are its keys: one is shared. If not, all
   its rare tokens are keys, and the prefix goes on into the frequent ones, where each two
   neighbours in the order are one key. A token that a similar set lacks breaks two such
   combinations and one that it has in addition breaks one, in all at most n / 2 of them
   where percent is 75; so with n / 2 - 2 (rare tokens) + 2 frequent tokens one is shared.
   Prefixes are n / 8 keys longer than that, so a similar pair shares more than n / 8 keys of
   the smaller set. Classes that share fewer keys with all others together are left out
   before any pair is made, pairs that share fewer before they are looked at.
3. Candidate pairs whose sizes or parity bitmaps rule the similarity out are dropped. Among
   the classes of a key the smallest is the leader. Each class is verified against its
   best leader, then against its other leaders in other components. Where a key still holds
   several components, every two classes of different components are compared by bitmaps
   inside tasks; twice only each class's likest partner goes on, then all that can be. Pairs
   inside a component are not needed: they can't change it. So a large group of near copies
   costs one comparison for each member, and no pair that could join two components is left
   out.

Frequency decides about the size of the index only, never about results. It is counted over
all documents by lossy counting: each task counts its shingles and reports those that reach
the share in its block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_names, small, stored, worker_tool
from ledgerloom.llm.components import connected_components

SHINGLE_WORDS = 5
FREQUENT_SHARE = 1 / 1000  # of all classes
FREQUENT_TOKENS = 1 << 18  # at most so many are broadcast, the most frequent ones (2 MB)
BLOCK_TOKENS = 4_000_000
SLICES = 64
BLOCK_CLASSES = 1024
FIRST_KEYS = 4  # of each class, where only its likest partner is looked for
_DESCRIBED = "kind int, id bigint, hash bigint, n bigint, s1 bigint, s2 bigint, bits array<bigint>"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LONG = 64  # bytes; longer words are hashed one by one
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
# A number for each byte at each place of a word, none for white space behind it.
_PLACED = _mixed(_mixed(np.arange(1, _LONG * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
_PLACED = np.where(_BLANK, np.uint64(0), _PLACED.reshape(_LONG, 256)).ravel()


def _word_hashes(data: bytes) -> np.ndarray:
    """64 bits for each run of other bytes than ASCII white space: the sum of its bytes' numbers
    at their places. Words are met all at once, 50,000 at a time."""
    import xxhash

    raw = np.frombuffer(data, dtype=np.uint8)
    blank = np.concatenate([[True], _BLANK[raw], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), 50_000):
        here = slice(at, at + 50_000)
        part = raw[starts[at] : ends[here][-1]]
        first = starts[here] - starts[at]
        place = np.arange(len(part)) - np.repeat(first, np.diff(first, append=len(part)))
        hashes[here] = np.add.reduceat(_PLACED[np.minimum(place, _LONG - 1) * 256 + part], first)
    for k in np.flatnonzero(ends - starts > _LONG):
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return hashes


def _distinct(tokens: np.ndarray) -> np.ndarray:
    tokens.sort()
    return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)]]


def shingle_sets(words_in_shingle: int = SHINGLE_WORDS):
    """A function from a text to its set of shingles: distinct 64-bit hashes, in order.

    Words are runs of other bytes than ASCII white space, A to Z in lower case: what the
    methods of bytes do. A text with fewer words is one shingle.
    """

    def of(text: str | None) -> np.ndarray:
        h = _word_hashes(text.encode().lower()) if text else ()
        if not len(h):
            return np.empty(0, dtype=np.uint64)
        words = min(len(h), words_in_shingle)
        runs = max(1, len(h) - words_in_shingle + 1)
        x = np.full(runs, words, dtype=np.uint64)
        for k in range(words):
            x = x * _M1 + h[k : k + runs]
        return _distinct(_mixed(x))

    return of


def _set_name(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    import xxhash

    one, two = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), dtype=np.int64)
    return int(one), int(two)


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """A bitmap of two to four bits a token, as 64-bit numbers: whether a place has an odd
    number of tokens. Two bitmaps differ in no more places than the sets do in tokens."""
    size = 64
    while size < 2 * len(tokens):
        size *= 2
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _describe(share: float):
    """Names, sizes and bitmaps of sets (kind 0), and counts of tokens frequent in a block
    (kind 1)."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = worker_tool("shingles", shingle_sets)
        names = ["kind", "id", "hash", "n", "s1", "s2", "bits"]
        block: dict[int, np.ndarray] = {}
        held = 0

        def frequent() -> pd.DataFrame:
            least = max(3, math.ceil(share / 2 * len(block)))
            tokens = np.concatenate(list(block.values()))
            block.clear()  # a worker holds the tokens once, and sorts them in place
            tokens.sort()
            often = tokens[least - 1 :][tokens[least - 1 :] == tokens[: 1 - least]]
            often = often[np.concatenate([[True], often[1:] != often[:-1]])] if len(often) else often
            counts = np.searchsorted(tokens, often, "right") - np.searchsorted(tokens, often, "left")
            zero = np.zeros(len(often), dtype=np.int64)
            return pd.DataFrame(
                {
                    "kind": 1,
                    "id": often.view(np.int64),
                    "hash": zero,
                    "n": counts,
                    "s1": zero,
                    "s2": zero,
                    "bits": None,
                }
            )

        for batch in batches:
            rows = []
            for doc_id, hashed, text in zip(batch["doc_id"], batch["hash"], batch["text"], strict=True):
                tokens = of(text)
                s1, s2 = _set_name(tokens) if len(tokens) else (0, 0)
                rows.append((0, doc_id, hashed, len(tokens), s1, s2, parity_bits(tokens)))
                if len(tokens) and s1 not in block:
                    block[s1] = tokens
                    held += len(tokens)
                if held >= BLOCK_TOKENS:
                    yield frequent()
                    held = 0
            yield pd.DataFrame(rows, columns=names)
        if block:
            yield frequent()

    return describe


def spare(n: int) -> int:
    """How many keys a set of n tokens has beyond the prefix that makes one key shared."""
    return n // 8 if n >= 16 else 0


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set: even numbers for single rare tokens, odd ones for combinations."""
    n = len(tokens)
    lacks = n - -(-n * percent // 100)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
        rare, common = tokens[~often], tokens[often]
    else:
        rare, common = tokens, tokens[:0]
    one = np.uint64(1)
    more = spare(n)
    if len(rare) > lacks + more:
        return rare[: lacks + 1 + more] & ~one
    # With o shared tokens the set lacks n - o and meets m - o others, m the other's size;
    # o is at least r (n + m) / (1 + r) for r = percent / 100 and m at least r n.
    breaks = 2 * n * (100 - percent) // 100 - 2 * len(rare)
    # A shared rare token makes up for two broken combinations, so spare ones count half.
    run = common[: max(0, breaks) + 2 + 2 * more]
    return np.concatenate([rare & ~one, _mixed(_mixed(run[:-1]) + run[1:]) | one])


def _index(frequent: np.ndarray, percent: int):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, done = worker_tool("shingles", shingle_sets), set()
        for batch in batches:
            keys, names = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
            for text in batch["text"]:
                tokens = of(text)
                if len(tokens) < 2:
                    continue
                s1, _ = _set_name(tokens)
                if s1 in done:  # a copy that this task has met
                    continue
                if len(done) > 1_000_000:
                    done.clear()
                done.add(s1)
                found = _distinct(prefix_keys(tokens, frequent, percent))
                keys.append(found)
                names.append(np.full(len(found), s1))
            yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "sid": np.concatenate(names)})

    return index


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: names of classes) that are similar.

    The texts of all b of one a meet its text in slices of a few hundred, each text being sent
    once for each of its pairs, which is a fraction of what its set takes; sets are made where
    they are compared. A slice is a run of sorted rows and is never held.
    """
    counts = pairs.groupBy(F.col("a").alias("_a")).agg(F.count("*").alias("_n"))
    sliced = pairs.join(stored(counts, "join-slices"), F.col("a") == F.col("_a"))
    count = F.least(F.lit(4096), F.ceil(F.col("_n") / 256))
    sliced = sliced.select("a", "b", F.pmod("b", count).cast("int").alias("slice"))
    places = sliced.select(F.col("b").alias("_sid"), "a", "slice", F.lit(1).alias("role")).unionByName(
        sliced.select(F.col("a").alias("_sid"), "a", "slice", F.lit(0).alias("role")).distinct()
    )
    places = stored(places, "join-places")
    names = reps.select("s1", F.col("rep").alias("_rep"), F.col("rep_hash").alias("_hash"))
    need = places.select("_sid").distinct().join(names, F.col("_sid") == F.col("s1")).drop("s1")
    need = stored(need, "join-need")
    same = (docs["doc_id"] == F.col("_rep")) & (docs["hash"] == F.col("_hash"))
    # Repeated rows of a class's text: one of them stays. Only texts move, never sets.
    texts = docs.join(small(need), same, "left_semi").groupBy("doc_id", "hash").agg(F.first("text").alias("text"))
    dealt = places.join(need, "_sid").withColumnRenamed("_sid", "sid")
    same = (texts["doc_id"] == F.col("_rep")) & (texts["hash"] == F.col("_hash"))
    dealt = texts.join(dealt, same).select("a", "slice", "role", "sid", "text")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = worker_tool("shingles", shingle_sets)
        leader, first = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            found = []
            for a, role, sid, text in zip(batch["a"], batch["role"], batch["sid"], batch["text"], strict=True):
                tokens = of(text)
                if role == 0:
                    leader, first = a, tokens
                elif a == leader:
                    least = min(len(first), len(tokens))
                    if 100 * least < percent * max(len(first), len(tokens)):
                        continue
                    at = np.minimum(np.searchsorted(first, tokens), len(first) - 1)
                    both = int((first[at] == tokens).sum())
                    if 100 * both >= percent * (len(first) + len(tokens) - both):
                        found.append((a, sid))
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    dealt = dealt.repartition("a", "slice").sortWithinPartitions("a", "slice", "role")
    return stored(dealt.mapInPandas(compare, "a bigint, b bigint"), "join-links")


def similar_documents(
    docs: DataFrame,
    percent: int = 75,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: float = FREQUENT_SHARE,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    ``component_id`` is the smallest id that links can reach, the row's own included.
    ``percent`` is 75 or more.

    Defined results: null, empty and blank texts have no shingles and link with nothing; rows
    with a null id come back with a null component and link with nothing; rows that share an
    id stand for their own texts; repeated rows agree; an empty table gives an empty table.
    Whole texts count, and sets are compared in full.
    """
    text = F.col(text_column)
    named = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    nameless = named.where("doc_id is null")
    named = named.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    result = _linked(named, percent, share).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id")
    )
    nameless = nameless.withColumn("doc_id", F.lit(None).cast("bigint"))
    counted = nameless.mapInPandas(_describe(share), _DESCRIBED).where("kind = 0")
    return result.unionByName(
        counted.select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id")
        )
    )


def _linked(named: DataFrame, percent: int, share: float) -> DataFrame:
    """``doc_id, hash, n, first, component`` for each row of ``named`` (doc_id, text and its
    hash, no null id): the smallest id that links can reach, null where it is the row's own,
    and a name of the component. Links are between texts, so rows that share an id may lie in
    different components."""
    if percent < 75:
        raise ValueError("the bound on broken combinations holds from 75 percent on")
    found = stored(named.mapInPandas(_describe(share), _DESCRIBED), "join-sets")
    sets = found.where("kind = 0").select(F.col("id").alias("doc_id"), "hash", "n", "s1", "s2", "bits")

    reps = sets.where("n > 0").groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "hash")).alias("rep"),
        F.min("n").alias("n"),
        F.count("*").alias("rows"),
        F.first("bits").alias("bits"),
    )
    reps = reps.select("s1", "s2", F.col("rep.doc_id").alias("rep"), F.col("rep.hash").alias("rep_hash"), "n", "rows", "bits")
    reps = stored(reps, "join-classes")
    least = max(3, share / 2 * reps.count())
    often = found.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    often = often.orderBy(F.col("n").desc(), "id").limit(FREQUENT_TOKENS).select("id").collect()
    frequent = np.sort(np.array([r[0] for r in often], dtype=np.int64).view(np.uint64))

    # Keys that several classes share, with the smallest class as leader. A frequent key is
    # led in slices first, so that no task gets all rows of a large group.
    index = named.mapInPandas(_index(frequent, percent), "key bigint, sid bigint")
    combined = F.col("key") % 2 != 0
    index = index.withColumn("slice", F.when(combined, F.pmod("sid", F.lit(SLICES))).otherwise(0).cast("int"))
    shared = stored(_led(index), "join-keys")
    counts = shared.groupBy(F.col("sid").alias("s1")).agg(F.count("*").alias("keys"))
    sizes = reps.groupBy("s1").agg(F.min("n").alias("n"))
    enough = counts.join(sizes, "s1").where(F.col("keys") > _spare(F.ceil(F.col("n") * percent / 100)))
    enough = small(stored(enough.select(F.col("s1").alias("_s1"), F.col("n").cast("int").alias("size")), "join-enough"))
    shared = shared.join(enough, F.col("sid") == F.col("_s1")).select("key", "slice", "sid", "size")
    shared = stored(_led(shared, "size"), "join-keys")
    pairs = shared.select(F.col("leader").alias("a"), F.col("sid").alias("b"))
    heads = shared.where(combined).select("key", "leader").distinct()
    first = heads.groupBy(F.col("key").alias("_key")).agg(F.min("leader").alias("a"))
    heads = heads.join(first, F.col("key") == F.col("_key")).select("a", F.col("leader").alias("b"))
    pairs = pairs.unionByName(heads).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("keys"))
    pairs = _possible(pairs, reps, percent)

    best = Window.partitionBy("b").orderBy(F.col("keys").desc(), "a")
    ranked = stored(pairs.withColumn("_rank", F.row_number().over(best)), "join-pairs")
    links = _verified(named, reps, ranked.where("_rank = 1").select("a", "b"), percent)
    of = _components(links)
    more = _across(ranked.where("_rank > 1").select("a", "b"), of)
    if not more.isEmpty():
        links = links.unionByName(_verified(named, reps, more, percent))
        of = _components(links)

    # What is left: two classes of a key, none of them its leader, in different components.
    known = ranked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Each class meets its likest one of every key first: that joins most of what is near.
    for best_only in (True, True, False):
        rows = _open_keys(shared, of)
        rest = _unlike(_first_keys(rows) if best_only else rows, reps, percent, best_only).join(known, ["a", "b"], "left_anti")
        rest = stored(rest, "join-rest")
        if not rest.isEmpty():
            links, known = links.unionByName(_verified(named, reps, rest, percent)), known.unionByName(rest)
            of = _components(links)

    # From classes to documents. Components are of classes: one id may be in several.
    joined = of
    ids = reps.select("s1", "rep")
    firsts = joined.join(ids, F.col("node") == F.col("s1")).groupBy("component").agg(F.min("rep").alias("first"))
    joined = joined.join(firsts.withColumnRenamed("component", "_c"), F.col("component") == F.col("_c")).drop("_c")
    classes = reps.join(joined, F.col("s1") == F.col("node"), "left").where("rows > 1 or node is not null")
    classes = classes.select(
        F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), F.coalesce("first", "rep").alias("first"), "component"
    )
    classes = small(stored(classes, "join-named"))
    same = (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    return sets.join(classes, same, "left").select(
        "doc_id", "hash", "n", "first", F.coalesce("component", "s1").alias("component")
    )


def _spare(n: Column) -> Column:
    return F.when(n >= 16, F.floor(n / 8)).otherwise(0)


def _led(index: DataFrame, *more: str) -> DataFrame:
    """Rows of keys that several classes share, with the smallest class as leader, and all rows
    of combinations (their slices meet later)."""
    group = Window.partitionBy("key", "slice")
    led = index.select(
        "key", "slice", "sid", *more, F.min("sid").over(group).alias("leader"), F.max("sid").over(group).alias("last")
    )
    return led.where((F.col("leader") != F.col("last")) | (F.col("key") % 2 != 0)).drop("last")


def _open_keys(shared: DataFrame, of: DataFrame) -> DataFrame:
    """``key, sid, size, of, times`` for the keys whose classes lie in several components.

    Keys with the same classes (the shingles of one passage) become one that counts ``times``:
    they are told by the number of their classes and a sum over hashes of them.
    """
    rows = shared.select("key", "sid", "size").join(of, F.col("sid") == F.col("node"), "left")
    rows = stored(rows.select("key", "sid", "size", F.coalesce("component", "sid").alias("of")), "join-placed")
    # A sum of numbers below 2^54 can't overflow; two of them are as good as one of 108 bits.
    one, two = (F.shiftrightunsigned(F.xxhash64("sid", F.lit(seed)), 10).cast("decimal(38,0)") for seed in (1, 2))
    keys = rows.groupBy("key").agg(
        F.min("of").alias("low"),
        F.max("of").alias("high"),
        F.count("*").alias("rows"),
        F.sum(one).alias("one"),
        F.sum(two).alias("two"),
    )
    keys = keys.where("low <> high").groupBy("rows", "one", "two")
    keys = keys.agg(F.min("key").alias("_key"), F.count("*").alias("times"), F.max("rows").alias("in_key"))
    keys = stored(keys.select("_key", "times", "in_key"), "join-open")
    kept = rows.join(keys, F.col("key") == F.col("_key")).drop("_key")
    return stored(kept, "join-open-rows")


def _first_keys(rows: DataFrame) -> DataFrame:
    """Of each class the ``FIRST_KEYS`` keys with the smallest hashes: like classes have like
    keys, so they likely agree in some of these. ``in_key`` counts the rows that are left."""
    first = Window.partitionBy("sid").orderBy(F.xxhash64("key"), "key")
    few = rows.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= FIRST_KEYS).drop("_nth", "in_key")
    few = stored(few, "join-first-rows")
    sizes = few.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("in_key")).where("in_key > 1")
    return few.join(sizes, F.col("key") == F.col("_key")).drop("_key")


def _unlike(rows: DataFrame, reps: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Pairs (a, b) of classes of one key, in different components, whose sizes, bitmaps and
    number of shared keys allow the similarity.

    All classes of a key are compared, but inside tasks and by bitmaps of a bit or two a token;
    only pairs that pass become rows; with ``best_only`` each class's likest in a cell. A key of many classes is cut into blocks of ``BLOCK_CLASSES``
    of them, each two of which are one cell: a task holds two blocks at a time.
    """
    words = F.col("bits")
    half = (F.size(words) / 2).cast("int")
    folded = F.zip_with(F.slice(words, F.lit(1), half), F.slice(words, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    short = reps.select(F.col("s1").alias("_s1"), F.when(F.size(words) > 1, folded).otherwise(words).alias("bits"))
    needed = rows.select(F.col("sid").alias("_sid")).distinct()
    short = stored(short.join(needed, F.col("_s1") == F.col("_sid"), "left_semi"), "join-bits")
    rows = rows.join(short, F.col("sid") == F.col("_s1")).drop("_s1")
    blocks = F.ceil(F.col("in_key") / BLOCK_CLASSES).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
    cells = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")
    rows = rows.select("key", "sid", "size", "of", "times", "bits", "block", cells)
    rows = rows.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
    rows = rows.drop("_other").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    lists = "a bigint, b array<bigint>, n array<bigint>, times array<bigint>"
    found = rows.mapInPandas(_compared(percent, best_only), lists)
    found = found.repartition("a").sortWithinPartitions("a")
    # A pair is the likest of some of its keys only, so keys count where all pairs are told.
    return found.mapInPandas(_merged(not best_only), "a bigint, b bigint")


def _compared(percent: int, best_only: bool):
    """Pairs of the rows of a cell that sizes and bitmaps allow. Rows come in the order of cells."""
    numbers = ["block", "size", "of", "times", "sid"]

    def matched(x: np.ndarray, one: np.ndarray, y: np.ndarray, other: np.ndarray, same: bool) -> Iterator[np.ndarray]:
        """Rows of ``x`` with rows of ``y``, whose bitmaps are as long or twice as long."""
        width = one.shape[1]
        if other.shape[1] > width:
            other = other[:, :width] ^ other[:, width:]
        step = max(1, 1_000_000 // (len(y) * width))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            little, much = np.minimum.outer(part[:, 1], y[:, 1]), np.maximum.outer(part[:, 1], y[:, 1])
            allowed = (part[:, 2, None] != y[:, 2]) & (100 * little >= percent * much)
            if same:
                allowed &= np.arange(len(y)) > np.arange(at, at + len(part))[:, None]
            i, j = np.nonzero(allowed)
            if not len(i):
                continue
            little, total = little[i, j], (little + much)[i, j]
            # Unsigned: of negative numbers the bits of the absolute value would be counted.
            apart = np.bitwise_count(one[at + i] ^ other[j]).sum(axis=1, dtype=np.int64)
            near = (100 + percent) * (total - apart) >= 2 * percent * total
            i, j, little, unlike = i[near], j[near], little[near], (apart / total)[near]
            if best_only and len(i):
                order = np.lexsort((unlike, i))
                order = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
                i, j, little = i[order], j[order], little[order]
            a, b = part[i, 4], y[j, 4]
            yield np.stack([np.minimum(a, b), np.maximum(a, b), little, part[i, 3]], axis=1)

    def of_width(rows: np.ndarray, bits: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        wide = np.fromiter(map(len, bits), dtype=np.int64, count=len(bits))
        return {
            w: (rows[wide == w], np.concatenate(bits[wide == w].tolist()).view(np.uint64).reshape(-1, w))
            for w in np.unique(wide).tolist()
        }

    def cell(low: int, high: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        rows = np.concatenate([r for r, _ in held])
        bits = np.concatenate([b for _, b in held])
        at = rows[:, 0]
        left = of_width(rows[at == low], bits[at == low])
        right = left if low == high else of_width(rows[at == high], bits[at == high])
        for wide, x in left.items():
            if wide in right:
                yield from matched(*x, *right[wide], low == high)
            if 2 * wide in right:
                yield from matched(*x, *right[2 * wide], False)
        if low != high:
            for wide, y in right.items():
                if 2 * wide in left:
                    yield from matched(*y, *left[2 * wide], False)

    def frame(found: list[np.ndarray]) -> pd.DataFrame:
        """The pairs found so far, as one list of partners for each class."""
        rows = _summed(np.concatenate([np.empty((0, 4), dtype=np.int64), *found]))
        first = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[:1, 0] ^ 1))
        lists = {name: np.split(rows[:, k], first[1:]) if len(rows) else [] for k, name in enumerate("abnt")}
        return pd.DataFrame({"a": rows[first, 0], "b": lists["b"], "n": lists["n"], "times": lists["t"]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        found: list[np.ndarray] = []
        at, size = None, 0
        for batch in batches:
            if not len(batch):
                continue
            ids, rows = batch[["key", "low", "high"]].to_numpy(np.int64), batch[numbers].to_numpy(np.int64)
            bits = batch["bits"].to_numpy()
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                here = tuple(ids[start].tolist())
                if here != at:
                    for pairs in cell(at[1], at[2], held) if held else ():
                        found.append(pairs)
                        size += len(pairs)
                        if size >= 500_000:
                            yield frame(found)
                            found, size = [], 0
                    held, at = [], here
                held.append((rows[start:end], bits[start:end]))
        if held:
            found.extend(cell(at[1], at[2], held))
        yield frame(found)

    return compare


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows of (a, b, n, times), each pair once, in order, with the sum of its times."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    if not len(rows):
        return rows
    first = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    times = np.add.reduceat(rows[:, 3], first)
    rows = rows[first]
    rows[:, 3] = times
    return rows


def _merged(counted: bool):
    """Each pair once, from sorted lists of partners; with ``counted`` those that share more keys
    than are spare. One class's partners are held at a time."""

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        last, size = None, 0

        def told() -> np.ndarray:
            rows = _summed(np.concatenate(held))
            spares = np.where(rows[:, 2] >= 16, rows[:, 2] // 8, 0)
            return rows[rows[:, 3] > spares, :2] if counted else rows[:, :2]

        for batch in batches:
            out = [np.empty((0, 2), dtype=np.int64)]
            for a, b, n, times in zip(batch["a"], batch["b"], batch["n"], batch["times"], strict=True):
                if a != last and held:
                    out.append(told())
                    held, size = [], 0
                last, size = a, size + len(b)
                held.append(np.stack([np.full(len(b), a), b, n, times], axis=1))
                if size > 1_000_000:
                    held = [_summed(np.concatenate(held))]
                    size = 0
            yield pd.DataFrame(np.concatenate(out), columns=["a", "b"])
        if held:
            yield pd.DataFrame(told(), columns=["a", "b"])

    return merged


def _possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps allow the similarity: most chance neighbours go here.

    With d different places, sets of n and m tokens share (n + m - d) / 2 at most.
    """
    a = reps.select(F.col("s1").alias("_sa"), F.col("n").alias("_na"), F.col("bits").alias("_ba"))
    b = reps.select(F.col("s1").alias("_sb"), F.col("n").alias("_nb"), F.col("bits").alias("_bb"))
    both = pairs.join(a, F.col("a") == F.col("_sa")).join(b, F.col("b") == F.col("_sb"))
    like = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")

    def folded(bits: Column, other: Column) -> Column:
        # Bitmaps of like sizes are as long as each other or twice as long.
        half = F.greatest(F.lit(1), (F.size(bits) / 2).cast("int"))
        short = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > F.size(other), short).otherwise(bits)

    a, b = F.col("_ba"), F.col("_bb")
    places = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(places, F.lit(0), lambda x, y: x + y)
    total = F.col("_na") + F.col("_nb")
    near = (100 + percent) * (total - apart) >= 2 * percent * total
    return both.where(like).where(near).select(*pairs.columns)


def _components(links: DataFrame) -> DataFrame:
    return stored(connected_components(links), "join-components")


def _across(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs of different components."""
    a = of.select(F.col("node").alias("_na"), F.col("component").alias("_ca"))
    b = of.select(F.col("node").alias("_nb"), F.col("component").alias("_cb"))
    placed = pairs.join(a, F.col("a") == F.col("_na"), "left").join(b, F.col("b") == F.col("_nb"), "left")
    apart = F.coalesce("_ca", "a") != F.coalesce("_cb", "b")
    return stored(placed.where(apart).select("a", "b"), "join-across")


def one_of_each_group(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without near copies: of each component one row stays, the one with the smallest
    id (null last), then with the smallest hash of its text.

    Rows are told apart by their texts: an id that several texts share, or a null one, is no
    link. Of rows that agree in id and text any one stays. Rows without shingles link with
    nothing, and all of them stay. Columns come through as they are.
    """
    h, g, a, place = free_names(docs, "_hash", "_gone", "_again", "_place")
    hashed = F.xxhash64(text_column)
    number = F.col(id_column).cast("bigint")
    named = docs.select(F.coalesce(number, hashed).alias("doc_id"), F.col(text_column).alias("text"), hashed.alias("hash"))
    linked = _linked(named, percent, FREQUENT_SHARE).where("n > 0")
    linked = linked.groupBy("hash").agg(F.min("component").alias("component"))
    texts = docs.select(hashed.alias("_text"), number.alias("id")).groupBy("_text")
    texts = texts.agg(F.min("id").alias("id"), F.count("*").alias("rows"))
    texts = stored(linked.join(texts, F.col("hash") == F.col("_text")).drop("_text"), "join-texts")
    best = texts.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("best"))
    best = best.select(F.col("component").alias("_of"), F.col("best.hash").alias("_best"))
    fates = texts.join(best, F.col("component") == F.col("_of"))
    fates = stored(fates.where("rows > 1 or hash <> _best").select("hash", (F.col("hash") == F.col("_best")).alias("stays")), "join-fates")

    gone = small(fates.where("not stays").select(F.col("hash").alias(g)))
    kept = docs.withColumn(h, hashed).join(gone, F.col(h) == F.col(g), "left_anti")
    # Of texts with several rows one row stays; a rank cut to 1 leaves one row in each task.
    again = small(fates.where("stays").select(F.col("hash").alias(a)))
    single = kept.join(again, F.col(h) == F.col(a), "left_anti")
    order = Window.partitionBy(h).orderBy(F.col(id_column).asc_nulls_last())
    ranked = kept.join(again, F.col(h) == F.col(a), "left_semi").withColumn(place, F.row_number().over(order))
    return single.unionByName(ranked.where(F.col(place) == 1).drop(place)).drop(h)
