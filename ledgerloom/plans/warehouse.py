"""The whole refresh: exports to raw, staging, star schema, marts and safe exports.

Each layer is written as Parquet and read back, so a later layer starts from files
instead of a long lineage, and the planner knows the size of every dimension. Readers keep
the former tables until all layers are written and their checks have passed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import dimensions as D
from ledgerloom.operators import exports, facts, marts, quality, staging
from ledgerloom.plans.versions import Refresh, read_tables
from ledgerloom.session import configure
from ledgerloom.sources.csv import stamp
from ledgerloom.sources.records import SURPLUS
from ledgerloom.sources.registry import SOURCES, ExportFolders, load_raw

STEPS = ("load", "build", "all")


@dataclass(frozen=True)
class WarehouseConfig:
    """Where exports come from, where tables go, and the shop's defaults."""

    folders: ExportFolders
    root: str
    calendar_start: dt.date = D.CALENDAR_START
    calendar_end: dt.date = D.CALENDAR_END
    as_of: dt.date | None = None
    timezone: str = "UTC"
    default_vendor: str = D.DEFAULT_VENDOR
    default_price: Decimal = D.DEFAULT_PRICE
    default_channel: str = facts.DEFAULT_CHANNEL
    # False gives NULL for malformed values instead of stopping.
    strict: bool = True
    # Set aside raw rows with malformed values, as ``rejected.<name>``, and load the others.
    quarantine: bool = False
    # Exports whose quoted fields hold no line breaks are read without an exchange.
    multiline: bool = True
    # Publish only if no check finds anything, but for those named.
    gate: bool = True
    allowed_checks: frozenset[str] = quality.REPORTED_ONLY
    # Partition order facts by month, for readers that ask for a range of days.
    monthly: bool = True


REASONS = "reject_reasons"

# Tables whose files are ranges of these columns.
LINE_ORDER = {
    "fact_order": ["order_id"],
    "fact_order_line": ["order_id", "line_number"],
    "fact_cogs_estimate": ["order_line_key", "cogs_key"],
}


def load_layer(
    refresh: Refresh, config: WarehouseConfig, use_sample: bool = False
) -> dict[str, DataFrame]:
    """Raw tables on disk. With ``quarantine`` each row says why it can't be typed, if so; one
    write holds both kinds."""
    tables = {}
    for name, df in load_raw(refresh.spark, config.folders, use_sample, config.multiline).items():
        checks = quality.row_checks(f"raw.{name}")
        if SURPLUS in df.columns:
            checks["more fields than headers"] = C.filled(F.col(SURPLUS))
        if config.quarantine:
            df = df.withColumn(REASONS, quality.reject_reasons(name, df.columns))
            # What is set aside is no violation of what is loaded.
            kept = F.col(REASONS).isNull()
            checks = {check: kept & bad for check, bad in checks.items()} | {"set aside": ~kept}
        tables[name] = refresh.save(f"raw/{name}", df, checks, named=f"raw.{name}")
    return tables


def accepted_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(REASONS).isNull()).drop(REASONS) if REASONS in raw.columns else raw


def rejected_rows(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw rows set aside, with their reasons, as ``rejected.<name>``."""
    return {
        f"rejected.{name}": df.where(F.col(REASONS).isNotNull())
        for name, df in raw.items()
        if REASONS in df.columns
    }


def staging_tables(raw: dict[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    cast = C.typed if strict else C.typed_lenient
    builders = {
        "stg_orders": (staging.stg_orders, "orders"),
        "stg_order_lines": (staging.stg_order_lines, "orders"),
        "stg_products": (staging.stg_products, "products"),
        "stg_customers": (staging.stg_customers, "customers"),
        "stg_product_sku_map": (staging.stg_product_sku_map, "product_sku_map"),
        "stg_material_costs": (staging.stg_material_costs, "material_costs"),
        "stg_recipes": (staging.stg_recipes, "recipes"),
        "stg_meta_ads": (staging.stg_meta_ads, "meta_ads"),
        "stg_gsc_daily": (staging.stg_gsc_daily, "gsc_daily"),
    }
    return {name: build(raw[source], cast) for name, (build, source) in builders.items()}


def dimension_tables(
    spark: SparkSession, stg: dict[str, DataFrame], config: WarehouseConfig
) -> dict[str, DataFrame]:
    return {
        "dim_date": D.calendar(spark, config.calendar_start, config.calendar_end),
        "dim_product": D.dim_product(
            stg["stg_product_sku_map"], stg["stg_products"], config.default_vendor,
            config.default_price,
        ),
        "dim_customer": D.dim_customer(stg["stg_orders"], stg["stg_customers"]),
        "dim_channel": D.dim_channel(spark),
        "dim_shipping_method": D.dim_shipping_method(stg["stg_orders"]),
        "dim_material": D.dim_material(stg["stg_material_costs"]),
    }


def mart_tables(t: dict[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Marts are lazy: they run when they are read, like views."""
    return {
        "kpi_sales_summary": marts.kpi_sales_summary(t["dim_date"], t["fact_order"], as_of),
        "kpi_revenue_totals": marts.kpi_revenue_totals(t["fact_order"]),
        "kpi_product_profitability": marts.kpi_product_profitability(
            t["dim_product"], t["fact_order_line"]
        ),
        "kpi_cogs_detail": marts.kpi_cogs_detail(
            t["dim_product"], t["fact_order_line"],
            facts.recipe_costs(t["stg_recipes"], t["dim_material"]),
        ),
        "kpi_customer_segments": marts.kpi_customer_segments(t["dim_customer"]),
        "kpi_new_vs_returning": marts.kpi_new_vs_returning(
            t["fact_order"], t["dim_customer"], t["dim_date"]
        ),
        "kpi_repeat_purchase_rate": marts.kpi_repeat_purchase_rate(t["dim_customer"]),
        "kpi_shipping_methods": marts.kpi_shipping_methods(
            t["fact_order"], t["dim_shipping_method"]
        ),
        "kpi_marketing_performance": marts.kpi_marketing_performance(t["fact_marketing_spend"]),
        "kpi_seo_performance": marts.kpi_seo_performance(t["fact_gsc_daily"], t["dim_date"]),
        "validation_order_totals": marts.validation_order_totals(t["fact_order"]),
    }


def build_layers(
    refresh: Refresh, config: WarehouseConfig, raw: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Staging, dimensions and facts on disk."""

    def save(layer: str, name: str, df: DataFrame, month_from: str | None = None) -> DataFrame:
        checks = quality.row_checks(name)
        return refresh.save(f"{layer}/{name}", df, checks, LINE_ORDER.get(name), month_from, name)

    t = {n: save("staging", n, stamp(df)) for n, df in staging_tables(raw, config.strict).items()}
    t |= {n: save("warehouse", n, df) for n, df in dimension_tables(refresh.spark, t, config).items()}

    costs = facts.recipe_costs(t["stg_recipes"], t["dim_material"])
    month_from = "order_date_key" if config.monthly else None
    t["fact_order"] = save(
        "warehouse",
        "fact_order",
        facts.fact_order(
            t["stg_orders"], t["stg_order_lines"], t["dim_shipping_method"],
            config.default_channel,
        ),
        month_from,
    )
    products = save("warehouse", "product_cost", facts.product_costs(t["stg_product_sku_map"], costs))
    t["fact_order_line"] = save(
        "warehouse",
        "fact_order_line",
        facts.fact_order_line(t["stg_order_lines"], t["fact_order"], products),
        month_from,
    )
    t["fact_cogs_estimate"] = save(
        "warehouse",
        "fact_cogs_estimate",
        facts.fact_cogs_estimate(t["fact_order_line"], t["dim_product"], costs),
    )
    t["fact_marketing_spend"] = save(
        "warehouse", "fact_marketing_spend", facts.fact_marketing_spend(t["stg_meta_ads"])
    )
    t["fact_gsc_daily"] = save("warehouse", "fact_gsc_daily", facts.fact_gsc_daily(t["stg_gsc_daily"]))
    return t


def refresh_report(refresh: Refresh, tables: dict[str, DataFrame], config: WarehouseConfig) -> DataFrame:
    """What the checks of a refresh found: rows counted by the writes, and the checks that
    compare rows, over the stored tables."""
    counted = [*refresh.violations]
    for name, entry in ((k.replace("raw/", "raw.").split("/")[-1], e) for k, e in refresh.entries.items()):
        if name in quality.MUST_HAVE_ROWS and name in tables:
            counted.append((name, "not empty", int(entry["rows"] == 0)))
    schema = "table_name string, check_name string, violations bigint"
    reports = [refresh.spark.createDataFrame(counted, schema)]
    if "fact_order" in tables:
        reports.append(quality.compared_rows(tables))
        exported = exports.all_exports(tables | mart_tables(tables, config.as_of))
        reports.append(quality.exported_personal_data(exported))
    return quality.union(reports)


def build_warehouse(
    spark: SparkSession, config: WarehouseConfig, step: str = "all", use_sample: bool = False
) -> dict[str, DataFrame]:
    """Run the refresh: ``load`` reads the exports, ``build`` makes the other layers.

    Returns every table by name, raw ones as ``raw.<name>``. Failures are raised, and so is
    what the checks find (``quality.QualityError``); then the former tables stay published.
    """
    if step not in STEPS:
        raise ValueError(f"step must be one of {STEPS}")
    configure(spark, config.timezone)
    refresh = Refresh(spark, config.root)
    try:
        if step == "build":
            raw = {spec.table: refresh.read(f"raw/{spec.table}") for spec in SOURCES}
        else:
            raw = load_layer(refresh, config, use_sample)
        tables = {f"raw.{name}": df for name, df in raw.items()} | rejected_rows(raw)
        raw = {name: accepted_rows(df) for name, df in raw.items()}
        if step != "load":
            tables |= build_layers(refresh, config, raw)
        if config.gate:
            quality.require_clean(refresh_report(refresh, tables, config), config.allowed_checks)
        refresh.publish()
    except BaseException:
        refresh.discard()
        raise
    return tables if step == "load" else tables | mart_tables(tables, config.as_of)


def read_warehouse(
    spark: SparkSession, config: WarehouseConfig, version: int | None = None
) -> dict[str, DataFrame]:
    """The published tables, as ``build_warehouse`` returns them."""
    stored = read_tables(spark, config.root, version)
    tables = {k.replace("raw/", "raw.").split("/")[-1]: df for k, df in stored.items()}
    tables.pop("product_cost", None)
    tables |= rejected_rows({k.removeprefix("raw."): df for k, df in tables.items() if k.startswith("raw.")})
    return tables | mart_tables(tables, config.as_of) if "fact_order" in tables else tables


def load_summary(t: dict[str, DataFrame]) -> DataFrame:
    """One row: orders, lines, customers, products, revenue and units."""
    def part(df: DataFrame, count: str, **sums: str) -> DataFrame:
        measures = {count: F.count("*"), **{k: F.sum(v) for k, v in sums.items()}}
        names = ("orders", "line_items", "customers", "products", "revenue", "units")
        empty = F.lit(None).cast("decimal(38,2)")
        return df.agg(*[measures.get(n, empty).cast("decimal(38,2)").alias(n) for n in names])

    parts = quality.union(
        [
            part(t["fact_order"], "orders", revenue="net_sales", units="unit_count"),
            part(t["fact_order_line"], "line_items"),
            part(t["dim_customer"], "customers"),
            part(t["dim_product"], "products"),
        ]
    )
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in parts.columns}
    return parts.agg(
        *[v.cast(C.MONEY_SUM if c == "revenue" else "bigint").alias(c) for c, v in total.items()]
    )


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Make tables, marts and exports available to ``spark.sql``; exports as ``export_<name>``."""
    named = dict(tables)
    if "kpi_revenue_totals" in tables:
        named |= {f"export_{name}": df for name, df in exports.all_exports(tables).items()}
    for name, df in named.items():
        df.createOrReplaceTempView(prefix + name.replace(".", "_"))


def write_exports(tables: dict[str, DataFrame], root: str, format: str = "parquet") -> list[str]:
    """Write every safe export below ``root``; returns the paths."""
    paths = []
    for name, df in exports.all_exports(tables).items():
        path = f"{root}/{name}"
        writer = df.write.mode("overwrite")
        if format == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.format(format).save(path)
        paths.append(path)
    return paths
