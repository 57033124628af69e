"""Hard negatives from candidate blocks in Hilbert order, chosen by zone maps.

Candidates are sorted along a Hilbert curve through all dimensions and cut into blocks. A
block is one row of a Parquet table: its vectors, and its zone map, the smallest and largest
value in each dimension and the labels it holds. Anchors are cut into groups in the same
order. What is asked for an anchor is a window of scores, and the label rule. Interval
arithmetic over a zone map bounds the inner product of an anchor with any vector of a block
from both sides, so a block is read for a group only if its bounds meet a window of one of
the group's anchors, and inside a task a block's products are computed only for the anchors
whose bounds meet what is still open.

Positives are asked for first with an open window, in the one block of the highest bound of
each anchor; what is found there closes the window from below for the whole search. A
positive's score then gives the window of its negatives.

Neither anchors nor candidates pass the driver. Blocks meet groups in slices of bounded size,
best bounds first; a task streams over its blocks and holds one group and one Arrow batch.
Scores are whole numbers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StructType,
)

from ledgerloom.llm.common import stored

BLOCK_ROWS = 2048  # candidates of a block
GROUP_ROWS = 4096  # anchors of a group
PAGE_BLOCKS = 1024  # zone maps of a page
SLICE_BLOCKS = 32  # blocks that meet a group in one stream
KNOWN_LABELS = 16  # a block of more labels counts as holding any
CURVE_BITS = 4  # steps of the curve in each dimension: 2^4
CHUNK = 256  # anchors of one matrix product
LEAST, MOST = -(2**62), 2**62

_PACKED = (
    StructType()
    .add("number", LongType())
    .add("n", IntegerType())
    .add("lo", ArrayType(IntegerType()))
    .add("hi", ArrayType(IntegerType()))
    .add("labels", ArrayType(LongType()))
    .add("ids", ArrayType(LongType()))
    .add("row_labels", ArrayType(LongType()))
    .add("vectors", BinaryType())
)


# ---- rows in curve order --------------------------------------------------------------


def integer_rows(vectors: DataFrame, id_column: str, label_column: str, vector_column: str, scale: int) -> DataFrame:
    """``id, label, v``: floor(scale x) of each component, of the rows that take part."""
    # Scores stay below 2^53 in size, so that doubles hold them and all sums on the way.
    x = F.transform(F.col(vector_column), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    length = F.aggregate(x, F.lit(0.0), lambda a, c: a + c * c)
    whole = F.forall(vector_column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < 2.0**30))
    present = F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & F.col(vector_column).isNotNull()
    usable = present & (F.size(vector_column) > 0) & whole
    return vectors.where(F.coalesce(usable, F.lit(False))).where(length < 2.0**53).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(label_column).cast("bigint").alias("label"),
        x.cast("array<int>").alias("v"),
    )


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of points along the Hilbert curve, as bytes that sort in curve order.

    ``cells`` has a row of whole numbers below 2^bits for each point. From the highest bit
    down, each axis turns or mirrors the lower bits of the first one; a Gray code over all
    axes then gives the place, whose bits are taken in turn from every axis.
    """
    x = np.ascontiguousarray(cells.T.astype(np.uint32))
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for i in range(axes):
            mirror = (x[i] >> bit) & 1 == 1
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & lower)
            x[i] ^= swap
            x[0] ^= np.where(mirror, lower, swap)
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1 == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flips
    planes = np.stack([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)])  # bit, axis, point
    packed = np.packbits(planes.reshape(bits * axes, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _runs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal numbers."""
    edges = np.flatnonzero(np.diff(lengths)) + 1
    yield from zip([0, *edges], [*edges, len(lengths)], strict=True) if len(lengths) else ()


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of vectors of one length: where they start and end, and the vectors."""
    lists = batch.column("v")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, at = lists.flatten().to_numpy(zero_copy_only=False), 0
    for a, b in _runs(lengths):
        size = int(lengths[a]) * (b - a)
        yield a, b, flat[at : at + size].reshape(b - a, -1)
        at += size


def in_curve_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``: the vector's length, then its place along the curve.

    A cell is a sixteenth of four deviations around the mean of all components.
    """
    total = F.aggregate("v", F.lit(0.0), lambda a, c: a + c)
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    n, s, s2 = rows.agg(F.sum(F.size("v")), F.sum(total), F.sum(square)).first()
    mean = s / n if n else 0.0
    spread = max(1.0, float(np.sqrt(max(0.0, s2 / n - mean * mean)))) if n else 1.0
    schema = StructType([*rows.schema.fields]).add("key", BinaryType())

    def add_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << CURVE_BITS
        for batch in batches:
            keys: list[bytes] = []
            for _, _, vectors in _matrices(batch):
                place = np.floor((vectors - mean) / (4 * spread) * cells + cells / 2)
                found = hilbert_keys(np.clip(place, 0, cells - 1), CURVE_BITS)
                keys += [vectors.shape[1].to_bytes(4, "big") + key for key in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=schema.names)

    return rows.mapInArrow(add_key, schema)


def packed(keyed: DataFrame, size: int) -> DataFrame:
    """Rows in curve order, ``size`` of one length to a row with its zone map.

    Equal vectors are told apart by id, so the ranges that tasks sort stay even.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        count = 0

        def row() -> pa.RecordBatch:
            nonlocal number, held, count
            ids, labels, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
            known = np.unique(labels)
            values = {
                "number": number,
                "n": vectors.shape[1],
                "lo": vectors.min(axis=0),
                "hi": vectors.max(axis=0),
                "labels": known if len(known) <= KNOWN_LABELS else None,
                "ids": ids,
                "row_labels": labels,
                "vectors": vectors.astype(np.int32).tobytes(),
            }
            number, held, count = number + 1, [], 0
            return _one_row(_PACKED, values)

        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for a, b, vectors in _matrices(batch):
                if held and held[0][2].shape[1] != vectors.shape[1]:
                    yield row()
                at = 0
                while at < b - a:
                    take = min(size - count, b - a - at)
                    held.append((ids[a + at : a + at + take], labels[a + at : a + at + take], vectors[at : at + take]))
                    count, at = count + take, at + take
                    if count == size:
                        yield row()
        if held:
            yield row()

    ordered = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "label", "v")
    return ordered.select("id", "label", "v").mapInArrow(pack, _PACKED)


def _arrow_type(field) -> pa.DataType:
    kinds = {LongType(): pa.int64(), IntegerType(): pa.int32(), BinaryType(): pa.binary(), DoubleType(): pa.float64()}
    if isinstance(field, ArrayType):
        return pa.list_(kinds[field.elementType])
    return kinds[field]


def _one_row(schema: StructType, values: dict) -> pa.RecordBatch:
    columns = [pa.array([values[f.name]], type=_arrow_type(f.dataType)) for f in schema.fields]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _values(batch: pa.RecordBatch, i: int) -> dict:
    """A row's values: lists of numbers as arrays, lists of structs as Arrow has them."""
    found = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        value = column[i]
        if not value.is_valid or not pa.types.is_list(column.type):
            found[name] = value.as_py()
        elif pa.types.is_struct(column.type.value_type):
            found[name] = value.values
        else:
            found[name] = value.values.to_numpy()
    return found


# ---- which blocks a group reads -------------------------------------------------------


class Group:
    """Anchors of one group, and what is asked: a window of scores for an anchor each."""

    def __init__(self, row: dict, k: int, same: bool) -> None:
        self.k, self.same = k, same
        self.ids = row["ids"]
        self.known, self.label = np.unique(row["row_labels"], return_inverse=True)
        self.vectors = np.frombuffer(row["vectors"], dtype=np.int32).reshape(len(self.ids), -1)
        exact = self.vectors.astype(np.float64)
        self.above, self.below = np.maximum(exact, 0), np.minimum(exact, 0)
        self.longest = float((exact**2).sum(axis=1).max())
        self.at, self.low, self.high = (row["asks"].field(x).to_numpy().copy() for x in ("at", "low", "high"))
        self.scores = np.full((len(self.at), k), LEAST)
        self.found = np.full((len(self.at), k), MOST)

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor (rows) with any vector of each zone."""
        lo, hi = np.atleast_2d(lo).astype(np.float64).T, np.atleast_2d(hi).astype(np.float64).T
        # Far from 2^53 all of this is exact; near it, rounding must not hide a score.
        slack = (self.above - self.below) @ np.maximum(np.abs(lo), np.abs(hi)) * 1e-12
        return self.above @ lo + self.below @ hi - slack, self.above @ hi + self.below @ lo + slack

    def wanted(self, lo: np.ndarray, hi: np.ndarray, labels: list) -> tuple[np.ndarray, np.ndarray]:
        """For each ask (rows) and zone: whether the zone may hold an answer, and its bound."""
        least, greatest = self.bounds(lo, hi)
        least, greatest = least[self.at], greatest[self.at]
        open_ = (greatest >= self.low[:, None]) & (least <= self.high[:, None]) & (self.low <= self.high)[:, None]
        may = np.ones((len(self.known), len(labels)), dtype=bool)
        for z, held in enumerate(labels):
            if held is not None:
                has = np.isin(self.known, held)
                may[:, z] = has if self.same else ~has | (len(held) > 1)
        return open_ & may[self.label[self.at]], greatest

    # ---- products ---------------------------------------------------------------------

    def take(self, row: dict) -> None:
        """Take a block's answers."""
        open_, _ = self.wanted(row["lo"], row["hi"], [row["labels"]])
        asks = np.flatnonzero(open_[:, 0])
        if not len(asks):
            return
        ids, labels = row["ids"], row["row_labels"]
        vectors = np.frombuffer(row["vectors"], dtype=np.int32).reshape(len(ids), -1)
        longest = float((vectors.astype(np.float64) ** 2).sum(axis=1).max())
        # Singles hold whole numbers up to 2^24.
        kind = np.float32 if self.longest * longest < 2.0**48 else np.float64
        anchors = np.unique(self.at[asks])
        candidates = vectors.astype(kind).T
        for a in range(0, len(anchors), CHUNK):
            some = anchors[a : a + CHUNK]
            scores = (self.vectors[some].astype(kind) @ candidates).astype(np.int64)
            alike = self.known[self.label[some]][:, None] == labels
            fits = alike & (self.ids[some][:, None] != ids) if self.same else ~alike
            mine = asks[(self.at[asks] >= some[0]) & (self.at[asks] <= some[-1])]
            local = np.searchsorted(some, self.at[mine])
            got = scores[local]
            hit = fits[local] & (got >= self.low[mine][:, None]) & (got <= self.high[mine][:, None])
            q, c = np.nonzero(hit)
            if len(q):
                self._keep(mine[q], got[q, c], ids[c])

    def _keep(self, asks: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge answers into the ``k`` best of each ask: highest score, then smallest id."""
        touched = np.unique(asks)
        old_q = np.repeat(touched, self.k)
        q = np.concatenate([old_q, asks])
        s = np.concatenate([self.scores[touched].ravel(), scores])
        i = np.concatenate([self.found[touched].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(starts, np.diff([*starts, len(q)]))
        top = place < self.k
        self.scores[q[top], place[top]], self.found[q[top], place[top]] = s[top], i[top]
        self.low[touched] = np.maximum(self.low[touched], self.scores[touched, -1])

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, place = np.nonzero(self.scores > LEAST)
        return q, self.found[q, place], self.scores[q, place]


def zone_pages(blocks: DataFrame) -> DataFrame:
    """Zone maps of about ``PAGE_BLOCKS`` blocks of one length to a row."""
    pages = max(1, -(-blocks.count() // PAGE_BLOCKS))
    zone = F.struct("number", "lo", "hi", "labels")
    page = F.pmod(F.xxhash64("number"), F.lit(pages)).alias("page")
    return blocks.groupBy("n", page).agg(F.collect_list(zone).alias("zones"))


def chosen_blocks(groups: DataFrame, pages: DataFrame, same: bool, first: bool = False) -> DataFrame:
    """``group, block, upper``: blocks that the group must read for what it asks.

    With ``first``, only the block of the highest bound for each ask. Groups meet all pages of
    their length; a page is a thousand zone maps, and the list of pages, one entry for some
    two million candidates, is all that is broadcast.
    """
    schema = StructType().add("group", LongType()).add("ask", IntegerType()).add("block", LongType()).add("upper", DoubleType())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a row is a group and a page
                row = _values(batch, i)
                group, zones = Group(row, 1, same), row["zones"]
                numbers = zones.field("number").to_numpy()
                lo = zones.field("lo").flatten().to_numpy().reshape(len(numbers), -1)
                hi = zones.field("hi").flatten().to_numpy().reshape(len(numbers), -1)
                open_, upper = group.wanted(lo, hi, zones.field("labels").to_pylist())
                upper = np.where(open_, upper, -np.inf)
                if first:
                    ask, zone = np.arange(len(upper)), upper.argmax(axis=1)
                    best = upper[ask, zone]
                    ask, zone, best = (x[best > -np.inf] for x in (ask, zone, best))
                else:
                    best = upper.max(axis=0, initial=-np.inf)
                    zone = np.flatnonzero(best > -np.inf)
                    best, ask = best[zone], np.zeros(len(zone))
                columns = [
                    pa.array(np.full(len(zone), row["group"]), pa.int64()),
                    pa.array(ask.astype(np.int32), pa.int32()),
                    pa.array(numbers[zone], pa.int64()),
                    pa.array(best, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    listed = F.broadcast(pages.select("n", "page"))
    met = groups.join(listed, "n").join(pages, ["n", "page"])
    found = met.select("group", "ids", "row_labels", "vectors", "asks", "zones").mapInArrow(choose, schema)
    if first:
        found = found.groupBy("group", "ask").agg(F.max_by("block", F.struct("upper", "block")).alias("block"), F.max("upper").alias("upper"))
    return found.groupBy("group", "block").agg(F.max("upper").alias("upper"))


def answers(groups: DataFrame, blocks: DataFrame, chosen: DataFrame, k: int, same: bool) -> DataFrame:
    """``group, ask, id, score, rank``: the ``k`` best answers to each ask in the chosen blocks.

    A group's blocks are dealt to slices; in a slice the group comes first, then its blocks
    by falling bound, so that good answers close windows early.
    """
    schema = StructType().add("group", LongType()).add("ask", IntegerType()).add("id", LongType()).add("score", LongType())
    chosen = stored(chosen, "negatives-chosen")
    slices = chosen.groupBy("group").agg(F.ceil(F.count("*") / SLICE_BLOCKS).cast("bigint").alias("slices"))
    dealt = chosen.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("block"), "slices"))
    payload = ["lo", "hi", "labels", "ids", "row_labels", "vectors"]
    ask_type = groups.schema["asks"].dataType
    of_blocks = dealt.join(blocks.withColumnRenamed("number", "block"), "block").select(
        "group", "slice", (-F.col("upper")).alias("place"), "block", *payload, F.lit(None).cast(ask_type).alias("asks")
    )
    of_groups = groups.join(slices, "group").select(
        "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"),
        F.lit(float("-inf")).alias("place"), F.lit(-1).cast("bigint").alias("block"), *payload, "asks",
    )
    streams = of_groups.unionByName(of_blocks).repartition("group", "slice")
    streams = streams.sortWithinPartitions("group", "slice", "place", "block")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number = None, 0

        def told() -> pa.RecordBatch:
            q, ids, scores = group.answers()
            columns = [
                pa.array(np.full(len(q), number), pa.int64()),
                pa.array(q.astype(np.int32), pa.int32()),
                pa.array(ids, pa.int64()),
                pa.array(scores, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            for i in range(batch.num_rows):  # a row is a group or a block
                row = _values(batch, i)
                if row["asks"] is None:
                    group.take(row)
                    continue
                if group is not None:
                    yield told()
                group, number = Group(row, k, same), row["group"]
        if group is not None:
            yield told()

    found = streams.select("group", *payload, "asks").mapInArrow(answer, schema)
    best = Window.partitionBy("group", "ask").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)


# ---- the operator ---------------------------------------------------------------------


def _floor_percent(score: Column, percent: int) -> Column:
    parts = score * percent
    return F.call_function("div", parts - F.pmod(parts, F.lit(100)), F.lit(100))


def _asks(asks: Column) -> Column:
    return asks.cast("array<struct<at:int,low:bigint,high:bigint>>").alias("asks")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    lower_percent: int = 80,
    upper_percent: int = 100,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are the ``positives`` best other rows of its label, and a positive's
    negatives the ``negatives`` best rows of other labels whose score lies between the two
    percentages of the positive's; the score is the inner product of whole-numbered vectors,
    ties go to the smaller id. ``is_anchor`` is a condition over ``id``.

    Rows with a null id, label or vector, an empty vector, a null or non-finite component or a
    squared length of 2^53 and more (after scaling) take no part; vectors of another length
    are no partners. Of rows that share an anchor's id the smallest (label, vector) asks, and
    none of them is its positive; repeated rows otherwise all count, as positives too. Other
    columns take no part. An empty table gives no rows.
    """
    rows = integer_rows(vectors, id_column, label_column, vector_column, scale)
    keyed = stored(in_curve_order(rows), "negatives-rows")
    blocks = stored(packed(keyed, block_rows), "negatives-blocks")
    pages = stored(zone_pages(blocks), "negatives-zones")

    asking = keyed.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v", "key")).alias("first"))
    anchors = packed(asking.select("id", "first.*"), group_rows)
    groups = stored(anchors.withColumnRenamed("number", "group"), "negatives-anchors")
    every = F.transform(
        F.sequence(F.lit(0), F.size("ids") - 1),
        lambda at: F.struct(at.alias("at"), F.lit(LEAST + 1).alias("low"), F.lit(MOST).alias("high")),
    )
    open_ = groups.withColumn("asks", _asks(every))

    # Positives: the best block of each anchor closes the windows for the search over all.
    near = answers(open_, blocks, chosen_blocks(open_, pages, True, first=True), positives, True)
    least = near.where(F.col("rank") == positives).groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("ask", "score"))).alias("least")
    )
    closed = open_.join(least, "group", "left").withColumn(
        "asks",
        _asks(
            F.transform(
                "asks",
                lambda a: F.struct(a.at.alias("at"), F.coalesce(F.try_element_at(F.col("least"), a.at), a.low).alias("low"), a.high.alias("high")),
            )
        ),
    )
    closed = stored(closed.drop("least"), "negatives-asks")
    found = stored(answers(closed, blocks, chosen_blocks(closed, pages, True), positives, True), "negatives-positives")

    # Negatives: a window for each anchor and positive.
    low = -_floor_percent(-F.col("score"), lower_percent)
    high = _floor_percent(F.col("score"), upper_percent)
    window = F.struct(F.col("ask").alias("at"), F.col("rank"), F.col("id"), F.col("score"), low.alias("low"), high.alias("high"))
    windows = found.groupBy("group").agg(F.array_sort(F.collect_list(window)).alias("windows"))
    asked = groups.join(windows, "group")
    asked = stored(
        asked.withColumn("asks", _asks(F.transform("windows", lambda w: F.struct(w.at, w.low, w.high)))), "negatives-windows"
    )
    hard = answers(asked.drop("windows"), blocks, chosen_blocks(asked.drop("windows"), pages, False), negatives, False)

    anchor = asked.select("group", "ids", F.posexplode("windows").alias("ask", "w")).select(
        "group",
        "ask",
        F.col("ids")[F.col("w.at")].alias("anchor_id"),
        F.col("w.id").alias("positive_id"),
        F.col("w.score").alias("positive_score"),
    )
    return hard.join(anchor, ["group", "ask"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
