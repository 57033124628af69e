"""Which export feeds which raw table, and where it is looked for."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schemas
from ledgerloom.sources import csv


@dataclass(frozen=True)
class ExportFolders:
    """Folders or object-store prefixes of the exports."""

    raw: str
    reference: str
    sample: str | None = None
    # Searched last for the search-performance chart.
    fallback: str | None = None


@dataclass(frozen=True)
class SourceSpec:
    table: str
    file: str
    sample_file: str | None = None
    # Folder names of ExportFolders, tried in this order.
    folders: tuple[str, ...] = ("raw",)
    required: bool = True
    columns: tuple[str, ...] = ()
    shape: Callable[[DataFrame], DataFrame] | None = None


# Names the shop, advertising and search tools give their exports. A
# pattern also takes an export that was split into several files.
SOURCES = [
    SourceSpec("orders", "orders_export_*.csv", "sample_orders.csv"),
    SourceSpec("products", "products_export_*.csv", "sample_products.csv"),
    SourceSpec("customers", "customers_export*.csv", "sample_customers.csv"),
    SourceSpec(
        "discounts", "discounts_export_*.csv", "sample_discounts.csv", required=False,
        columns=("name", "value", "value_type", "type", "times_used", "status", "start", "end"),
    ),
    SourceSpec("product_sku_map", "product_sku_map.csv", folders=("reference",)),
    # Costs and recipes are kept private next to the raw exports; the shared reference
    # folder may hold an example.
    SourceSpec("material_costs", "material_costs.csv", folders=("raw", "reference")),
    SourceSpec("recipes", "recipes.csv", folders=("raw", "reference")),
    SourceSpec(
        "meta_ads", "*Campaigns*.csv", required=False,
        columns=tuple(schemas.RAW_ADS), shape=csv.ads_columns,
    ),
    SourceSpec(
        "gsc_daily", "*Performance-on-Search*/Chart.csv", folders=("raw", "fallback"),
        required=False, columns=tuple(schemas.RAW_SEARCH),
    ),
]


def load_raw(
    spark: SparkSession,
    folders: ExportFolders,
    use_sample: bool = False,
    multiline: bool = True,
    sources: list[SourceSpec] | None = None,
) -> dict[str, DataFrame]:
    """Read every registered export as text, plus ``loaded_at``.

    A missing or empty optional export gives an empty table with its columns; a missing
    required one raises.
    """
    return {
        spec.table: _load(spark, spec, folders, use_sample, multiline)
        for spec in (sources or SOURCES)
    }


def _load(
    spark: SparkSession, spec: SourceSpec, folders: ExportFolders, use_sample: bool, multiline: bool
) -> DataFrame:
    paths = _candidates(spec, folders, use_sample)
    df = csv.first_found(spark, paths, multiline, surplus=True)
    if df is None:
        if spec.required:
            raise csv.MissingSource(f"{spec.table}: no rows in any of {paths}")
        df = csv.empty(spark, list(spec.columns))
    elif spec.shape is not None:
        df = spec.shape(df)
    return csv.stamp(df)


def _candidates(spec: SourceSpec, folders: ExportFolders, use_sample: bool) -> list[str]:
    if use_sample and spec.sample_file is not None:
        if folders.sample is None:
            raise ValueError("a sample folder is needed to load sample data")
        return [f"{folders.sample}/{spec.sample_file}"]
    bases = [getattr(folders, name) for name in spec.folders]
    return [f"{base}/{spec.file}" for base in bases if base]
