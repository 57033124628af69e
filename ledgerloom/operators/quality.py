"""Data-quality checks as Spark jobs.

A check gives rows of ``(table_name, check_name, violations)``. All row-level checks of a
table are counted in one pass over it; checks on keys aggregate before they compare.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import columns as C
from ledgerloom.operators import exports, marts
from ledgerloom.sources.records import SURPLUS

REPORT_COLUMNS = ["table_name", "check_name", "violations"]

# Tables that must not be empty.
MUST_HAVE_ROWS = [
    "raw.orders", "raw.product_sku_map", "raw.material_costs", "raw.recipes",
    "stg_orders", "fact_order", "fact_order_line", "dim_product", "dim_customer", "dim_date",
    "fact_cogs_estimate",
]


# Checks that describe the shop's data: they are reported and stop nothing.
REPORTED_ONLY = frozenset(
    {
        "subtotal differs", "total differs", "line sum differs", "line name without SKU",
        "cost flag wrong", "set aside",
    }
)


class QualityError(AssertionError):
    """At least one check found violations."""


def union(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _report(df: DataFrame, table: str, check: str) -> DataFrame:
    """Turn a one-row frame with a ``violations`` column into a report."""
    return df.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


# ---- row-level checks -----------------------------------------------------------------

def count_violations(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """How many rows meet each condition, in a single pass."""
    counted = df.agg(
        *[F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(checks.values())]
    )
    pairs = [x for i, check in enumerate(checks) for x in (F.lit(check), F.col(f"c{i}"))]
    return counted.select(
        F.lit(table).alias("table_name"),
        F.stack(F.lit(len(checks)), *pairs).alias("check_name", "violations"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return row_counts(tables).select(
        "table_name",
        F.lit("not empty").alias("check_name"),
        (F.col("row_count") == 0).cast("bigint").alias("violations"),
    )


def blank(column: str) -> Column:
    return ~C.filled(F.col(column)) | F.col(column).isNull()


def raw_order_checks() -> dict[str, Column]:
    return {
        "blank id": blank("id"),
        "blank created_at": blank("created_at"),
        "created_at not a timestamp": C.filled(F.col("created_at"))
        & F.col("created_at").try_cast("timestamp").isNull(),
    }


def staged_order_checks() -> dict[str, Column]:
    return {
        "missing created_at": F.col("created_at").isNull(),
        "negative amount": (F.col("subtotal") < 0) | (F.col("total") < 0) | (F.col("shipping") < 0),
    }


def sku_map_checks() -> dict[str, Column]:
    return {"no recipe": blank("recipe_id")}


def fact_order_checks() -> dict[str, Column]:
    return {
        "subtotal differs": ~marts.within_tolerance(marts.subtotal_gap()),
        "total differs": ~marts.within_tolerance(marts.total_gap()),
        "negative net sales": F.col("net_sales") < 0,
    }


def fact_line_checks() -> dict[str, Column]:
    return {"negative cost": F.col("estimated_cogs") < 0}


def customer_checks() -> dict[str, Column]:
    return {"no hash": blank("customer_id_hash")}


def declared_checks(table: str) -> dict[str, Column]:
    """NOT NULL and text-length rules of a table's declaration."""
    checks = {f"{c} is null": F.col(c).isNull() for c in schemas.NOT_NULL.get(table, [])}
    for column, longest in schemas.MAX_LENGTH.get(table, {}).items():
        checks[f"{column} longer than {longest}"] = F.length(column) > longest
    return checks


def row_checks(table: str) -> dict[str, Column]:
    """Every check of a table that a single row decides; raw tables are called ``raw.<name>``."""
    own = {
        "raw.orders": raw_order_checks,
        "stg_orders": staged_order_checks,
        "stg_product_sku_map": sku_map_checks,
        "fact_order": fact_order_checks,
        "fact_order_line": fact_line_checks,
        "dim_customer": customer_checks,
    }
    checks = own[table]() if table in own else {}
    return {**checks, **declared_checks(table)}


def malformed(table: str, columns: list[str]) -> dict[str, Column]:
    """For each typed column of a raw table, whether a filled value is not of its type.

    ``table`` is a key of ``schemas.RAW_TYPES``, with or without ``raw.`` before it.
    """
    table = table.removeprefix("raw.")
    found = {}
    for c, type_name in schemas.RAW_TYPES.get(table, {}).items():
        if c not in columns:
            continue
        text = F.col(c)
        if c in schemas.WITH_CURRENCY_SIGN:
            text = C.bare_amount(text)
        if (table, c) in schemas.WITH_PERCENT_SIGN:
            text = F.replace(text, F.lit("%"), F.lit(""))
        # A day has one spelling; other types take what a cast takes.
        value = F.try_to_date(text, "yyyy-MM-dd") if type_name == "date" else text.try_cast(type_name)
        found[c] = C.filled(text) & value.isNull()
    return found


def rejected_values(raw: DataFrame, table: str) -> DataFrame:
    """Filled text values that a lenient load would turn into NULL, in a single pass."""
    types = schemas.RAW_TYPES[table.removeprefix("raw.")]
    checks = {f"{c} is not {types[c]}": bad for c, bad in malformed(table, raw.columns).items()}
    return count_violations(raw, table, checks)


def reject_reasons(table: str, columns: list[str]) -> Column:
    """Why a raw row can't be typed: ``column is not type: value`` each; NULL if it can."""
    types = schemas.RAW_TYPES.get(table.removeprefix("raw."), {})
    found = [
        F.when(bad, F.concat(F.lit(f"{c} is not {types[c]}: "), F.col(c)))
        for c, bad in malformed(table, columns).items()
    ]
    if SURPLUS in columns:
        found.append(F.when(C.filled(F.col(SURPLUS)), F.concat(F.lit("more fields than headers: "), F.col(SURPLUS))))
    none = F.lit(None).cast("array<string>")
    if not found:
        return none
    reasons = F.array_compact(F.array(*found))
    return F.when(F.size(reasons) > 0, reasons).otherwise(none)


# ---- keys -----------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. NULL keys never clash, as in a unique constraint."""
    return df.dropna(subset=keys).groupBy(*keys).count().where("count > 1")


def unique_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    dupes = duplicate_keys(df, keys).agg(F.count("*").alias("violations"))
    return _report(dupes, table, f"duplicate {', '.join(keys)}")


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Values that clash in the declared keys of the given tables, in two steps.

    First all keys of all tables go through one aggregation as 64-bit hashes. A hash that
    comes once is a key that comes once. Only keys under a hash that comes again are then
    counted themselves, so that two keys with one hash are not taken for the same.
    """
    hashed = [
        df.dropna(subset=schemas.UNIQUE_KEYS[name]).select(
            F.lit(i).alias("t"), F.xxhash64(*schemas.UNIQUE_KEYS[name]).alias("h")
        )
        for i, (name, df) in enumerate(tables.items())
    ]
    again = union(hashed).groupBy("t", "h").agg(F.count("*").alias("n")).where("n > 1")
    keys = [
        df.dropna(subset=schemas.UNIQUE_KEYS[name]).select(
            F.lit(i).alias("t"),
            F.xxhash64(*schemas.UNIQUE_KEYS[name]).alias("h"),
            F.to_json(F.struct(*schemas.UNIQUE_KEYS[name])).alias("key"),
        )
        for i, (name, df) in enumerate(tables.items())
    ]
    clashing = union(keys).join(again.select("t", "h"), ["t", "h"])
    dupes = clashing.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    found = dupes.groupBy("t").agg(F.count("*").alias("found"))
    named = [
        F.struct(
            F.lit(i).alias("t"),
            F.lit(name).alias("table_name"),
            F.lit(f"duplicate {', '.join(schemas.UNIQUE_KEYS[name])}").alias("check_name"),
        )
        for i, name in enumerate(tables)
    ]
    spark = next(iter(tables.values())).sparkSession
    listed = spark.range(1).select(F.inline(F.array(*named)))
    return listed.join(found, "t", "left").select(
        "table_name", "check_name", F.coalesce("found", F.lit(0)).cast("bigint").alias("violations")
    )


def broken_references(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values of a reference without a parent row, and how many rows hold each.

    The child is reduced to its distinct values first, so a value in very many rows is
    compared once.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def referential(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared references between the given tables: rows whose value has no parent row.

    Each table is read once, for all its references and all keys that others refer to. Its
    values are stacked as (reference, value) with a count of child rows or the mark of a
    parent row; one aggregation over all tables then tells which values have no parent.
    """
    known = [r for r in enumerate(schemas.REFERENCES) if r[1][0] in tables and r[1][2] in tables]
    stacked = []
    for name, df in tables.items():
        entries = [(i, column, 0) for i, (child, column, _, _) in known if child == name]
        entries += [(i, column, 1) for i, (_, _, parent, column) in known if parent == name]
        if entries:
            values = [
                F.struct(
                    F.lit(i).alias("reference"),
                    F.col(column).cast("string").alias("value"),
                    F.lit(parent).alias("parent"),
                )
                for i, column, parent in entries
            ]
            stacked.append(df.select(F.inline(F.array(*values))))
    found = (
        reduce(DataFrame.unionByName, stacked)
        .where("value IS NOT NULL")
        .groupBy("reference", "value")
        .agg(F.count_if(F.col("parent") == 0).alias("rows"), F.max("parent").alias("parent"))
    )
    broken = found.groupBy("reference").agg(
        F.sum(F.when(F.col("parent") == 0, F.col("rows")).otherwise(F.lit(0))).alias("broken")
    )
    # A reference between empty tables has no row above.
    named = [
        F.struct(F.lit(i).alias("reference"), F.lit(child).alias("table_name"),
                 F.lit(f"{column} without {parent}").alias("check_name"))
        for i, (child, column, parent, _) in known
    ]
    spark = next(iter(tables.values())).sparkSession
    listed = spark.range(1).select(F.inline(F.array(*named)))
    return listed.join(broken, "reference", "left").select(
        "table_name", "check_name", F.coalesce("broken", F.lit(0)).cast("bigint").alias("violations")
    )


def unmapped_lines(lines: DataFrame, sku_map: DataFrame) -> DataFrame:
    """Line names that no SKU stands for, with their number of lines."""
    names = lines.groupBy("lineitem_name").agg(F.count("*").alias("line_count"))
    return names.join(sku_map, "lineitem_name", "left_anti")


# ---- sums and flags -------------------------------------------------------------------

def line_sum_gaps(fact_orders: DataFrame, fact_lines: DataFrame) -> DataFrame:
    """Orders whose line revenues do not add up to their gross sales."""
    sums = fact_lines.groupBy("order_key").agg(F.sum("gross_line_revenue").alias("line_gross"))
    gap = F.abs(F.col("gross_product_sales") - F.col("line_gross"))
    return (
        fact_orders.select("order_key", "order_id", "gross_product_sales")
        .join(sums, "order_key")
        .select("order_id", "gross_product_sales", "line_gross", gap.alias("diff"))
        .where(~marts.within_tolerance(F.col("diff")))
    )


def wrong_cost_flags(fact_lines: DataFrame, cogs: DataFrame) -> DataFrame:
    """Lines marked as fully costed although an ingredient has no known cost."""
    unknown = cogs.groupBy("order_line_key").agg(
        F.count_if(~F.col("has_known_cost")).alias("unknown_count")
    )
    return (
        fact_lines.where(~F.col("has_missing_cost"))
        .select("order_line_key", "has_missing_cost")
        .join(unknown.where("unknown_count > 0"), "order_line_key")
    )


def _rows(df: DataFrame, table: str, check: str) -> DataFrame:
    return _report(df.agg(F.count("*").alias("violations")), table, check)


# ---- exports --------------------------------------------------------------------------

def looks_like_address(text: Column) -> Column:
    """Whether an e-mail address is somewhere in a text: ``[^@ ]+@[^@ ]+[.][^@ ]+``.

    A text without an ``@`` is not searched, and one character is asked for at either end:
    a run there would be tried from each of its places, the square of its length.
    """
    return F.contains(text, F.lit("@")) & text.rlike("[^@ ]@[^@ ]+[.][^@ ]")


def personal_data(exported: dict[str, DataFrame]) -> DataFrame:
    """Forbidden columns, and rows with something like an e-mail address in any text column."""
    reports = []
    for name, df in exported.items():
        texts = [c for c, t in df.dtypes if t == "string"]
        address = reduce(
            lambda a, b: a | b,
            [looks_like_address(F.col(c)) for c in texts],
            F.lit(False),
        )
        found = len(exports.forbidden_columns(df))
        reports.append(
            count_violations(df, name, {"text looks like an e-mail": address}).withColumn(
                "forbidden_columns", F.lit(found).cast("bigint")
            )
        )
    return union(reports)


# ---- report ---------------------------------------------------------------------------

def compared_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every check that compares rows: keys, references, sums over lines, flags, names."""
    reports = [unique_keys({n: tables[n] for n in schemas.UNIQUE_KEYS if n in tables}), referential(tables)]
    unmapped = unmapped_lines(tables["stg_order_lines"], tables["stg_product_sku_map"])
    reports.append(_rows(unmapped, "stg_order_lines", "line name without SKU"))
    gaps = line_sum_gaps(tables["fact_order"], tables["fact_order_line"])
    reports.append(_rows(gaps, "fact_order", "line sum differs"))
    flags = wrong_cost_flags(tables["fact_order_line"], tables["fact_cogs_estimate"])
    reports.append(_rows(flags, "fact_order_line", "cost flag wrong"))
    return union(reports)


def exported_personal_data(exported: dict[str, DataFrame]) -> DataFrame:
    found = personal_data(exported)
    return found.withColumn("violations", F.col("violations") + F.col("forbidden_columns")).select(*REPORT_COLUMNS)


def dq_report(
    raw: dict[str, DataFrame], tables: dict[str, DataFrame], exported: dict[str, DataFrame]
) -> DataFrame:
    """Every check over a built warehouse."""
    known = {**{f"raw.{k}": v for k, v in raw.items()}, **tables}
    reports = [empty_tables({k: known[k] for k in MUST_HAVE_ROWS if k in known})]
    for table, df in known.items():
        checks = row_checks(table)
        if checks:
            reports.append(count_violations(df, table, checks))
    return union([*reports, compared_rows(tables), exported_personal_data(exported)])


def require_clean(report: DataFrame, allowed: set[str] | None = None) -> None:
    """Raise if a check outside ``allowed`` found something. The report is one row per check."""
    found = report.where("violations > 0").collect()
    bad = [r for r in found if r["check_name"] not in (allowed or set())]
    if bad:
        raise QualityError(
            "; ".join(f"{r['table_name']}: {r['check_name']} ({r['violations']})" for r in bad)
        )
