"""Row numbers inside groups that may be very large.

A plain ``row_number`` sends a whole group to one task. Here a group that holds a large share
of all rows is cut into ranges of its order. The borders are quantiles: rows of the group,
picked by a hash of their values. A row's number is its number inside its range, plus the
rows in earlier ranges, which are prefix sums over one count per range. All of it is one
plan: nothing runs while it is built, and the same rows get the same numbers on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.hotkeys import SHARES, find_busy, quoted

COPIES_PER_ROW = 100_000
# Borders are searched in two steps: among every STRIDE-th one, then between two of these.
STRIDE = 64


def number_rows(
    df: DataFrame,
    keys: list[str],
    levels: list[list[str]],
    name: str,
    shares: int = SHARES,
    first: str | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... inside each ``keys`` group, as bigint.

    Rows are ordered by the columns of ``levels``, then by all remaining columns, nulls
    first, so the result is the same on every run. ``first`` names a boolean column that
    is true on one row per group and value of the first level.

    Groups with at most 1 / ``shares`` of all rows are one range each; so a window never
    sees much more than that share, whatever a group holds.
    """
    cut = _Cut(df, keys, levels, shares)
    window = f"OVER (PARTITION BY {cut.listed(keys)} ORDER BY {cut.listed(cut.order)})"
    added = [f"CAST(row_number() {window} AS BIGINT) AS {quoted(name)}"]
    if first is not None:
        added.append(f"{cut.opens(f'lag({cut.top}) {window}')} AS {quoted(first)}")
    whole = cut.met(df, cut.large, "left_anti").selectExpr("*", *added)
    return whole.unionByName(cut.numbered(name, first))


class _Cut:
    """The plan that cuts large groups of a table into ranges."""

    def __init__(self, df: DataFrame, keys: list[str], levels: list[list[str]], shares: int) -> None:
        self.df, self.keys, self.shares = df, keys, shares
        named = {*keys, *(c for level in levels for c in level)}
        rest = [c for c in df.columns if c not in named]
        self.order = [c for level in [*levels, rest] for c in level]
        self.place = f"struct({self.listed(self.order)})"
        self.top = f"struct({self.listed(levels[0])})"
        # At most one group per share, with the number of all rows.
        busy = find_busy(df, keys, shares)
        self.large = F.broadcast(busy.selectExpr(*self.renamed(), "_total"))

    @staticmethod
    def listed(columns: list[str]) -> str:
        return ", ".join(map(quoted, columns))

    def renamed(self) -> list[str]:
        return [f"{quoted(c)} AS _k{i}" for i, c in enumerate(self.keys)]

    def groups(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.keys))]

    def met(self, rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
        """A join with one row per group; NULL keys are a group as well."""
        same = " AND ".join(f"{quoted(c)} <=> _k{i}" for i, c in enumerate(self.keys))
        return rows.join(groups, F.expr(same), how)

    def opens(self, before: str) -> str:
        """Whether a row is the first of its value: there is no row before, or another value."""
        return f"({before} IS NULL OR NOT ({before} <=> {self.top}))"

    def borders(self) -> DataFrame:
        """The quantiles that cut each large group: its rows with a small hash.

        About ``shares`` rows of the whole table are picked, so this list doesn't grow with it.
        """
        drawn = f"(xxhash64({self.listed(self.order)}) / pow(2D, 64) + 0.5D) * _total < {self.shares}"
        picked = self.met(self.df, self.large, "inner").where(drawn)
        places = picked.selectExpr(*self.groups(), f"{self.place} AS _place").distinct()
        return places.groupBy(*self.groups()).agg(F.expr("array_sort(collect_list(_place)) AS _borders"))

    def ranged(self, rows: DataFrame, borders: DataFrame) -> DataFrame:
        """Rows of the groups of ``borders``, with ``_range``: how many borders are not above.

        Every STRIDE-th border is asked first, then those up to the next one.
        """
        every = f"transform(sequence(0, size(_borders) - 1, {STRIDE}), i -> get(_borders, i))"
        coarse = f"size(filter({every}, b -> b <= {self.place}))"
        rows = self.met(rows, F.broadcast(borders), "inner").selectExpr(
            "*", f"if(_borders IS NULL, 0, greatest(({coarse} - 1) * {STRIDE}, 0)) AS _start"
        )
        fine = f"size(filter(slice(_borders, _start + 1, {STRIDE}), b -> b <= {self.place}))"
        return rows.selectExpr("* EXCEPT (_start)", f"if(_borders IS NULL, 0, _start + {fine}) AS _range")

    def cuts(self) -> DataFrame:
        """For each large group its borders, and of each range the number of rows in earlier
        ones and the last value of the first level among these, as a map by range."""
        groups = self.groups()
        borders = self.borders()
        borders = borders.selectExpr(*[f"{g} AS _b{g}" for g in groups], "_borders")
        same = " AND ".join(f"{g} <=> _b{g}" for g in groups)
        both = self.large.join(borders, F.expr(same), "left").select(*groups, "_borders")
        counts = self.ranged(self.df.select(*self.keys, *self.order), both).groupBy(*groups, "_range")
        counts = counts.agg(
            F.expr("count(*) AS _rows"), F.expr(f"max({self.top}) AS _top"), F.expr("any_value(_borders) AS _borders")
        )
        window = f"OVER (PARTITION BY {', '.join(groups)} ORDER BY _range"
        entry = counts.selectExpr(
            *groups,
            "_borders",
            "_range",
            f"struct(coalesce(sum(_rows) {window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS offset,"
            f" lag(_top) {window}) AS last) AS _cut",
        )
        return entry.groupBy(*groups).agg(
            F.expr("any_value(_borders) AS _borders"),
            F.expr("map_from_entries(collect_list(struct(_range, _cut))) AS _ranges"),
        )

    def numbered(self, name: str, first: str | None) -> DataFrame:
        """The rows of large groups with their numbers.

        Equal rows have one place in the order: they are one row with a count until the end.
        """
        columns = [quoted(c) for c in self.df.columns]
        distinct = self.met(self.df, self.large, "left_semi").groupBy(*self.df.columns).agg(F.expr("count(*) AS _n"))
        window = f"OVER (PARTITION BY {self.listed(self.keys)}, _range ORDER BY {self.listed(self.order)}"
        placed = self.ranged(distinct, self.cuts()).selectExpr(
            *columns,
            "_n",
            "_ranges[_range] AS _cut",
            f"coalesce(sum(_n) {window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _inside",
            f"lag({self.top}) {window}) AS _previous",
        )
        # Copies of one row are written out in slices that are spread over tasks first.
        slices = placed.selectExpr(
            *columns,
            "_n",
            "_inside + _cut.offset AS _before",
            "coalesce(_previous, _cut.last) AS _previous",
            f"explode(sequence(0L, _n - 1, {COPIES_PER_ROW}L)) AS _from",
        ).repartition(*self.keys, "_before", "_from")
        copies = slices.selectExpr("*", f"explode(sequence(_from + 1, least(_from + {COPIES_PER_ROW}, _n))) AS _copy")
        added = [f"CAST(_before + _copy AS BIGINT) AS {quoted(name)}"]
        if first is not None:
            added.append(f"_copy = 1 AND {self.opens('_previous')} AS {quoted(first)}")
        return copies.selectExpr(*columns, *added)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group in the given order.

    Filtering a row number to 1 lets Spark cut every group to one row per task before the
    exchange, so a large group costs no more than a small one.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
