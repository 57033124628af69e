"""Text exports to all-string DataFrames."""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import columns as C
from ledgerloom.sources import records

logger = logging.getLogger(__name__)

# ---- fixed values ---------------------------------------------------------------------

# Cleaned header of an advertising export -> column of the raw table.
ADS_COLUMNS = {
    "campaign_name": "campaign_name",
    "reach": "reach",
    "frequency": "frequency",
    "impressions": "impressions",
    "cpm_cost_per_1_000_impressions": "cpm",
    "amount_spent_usd": "amount_spent",
    "link_clicks": "link_clicks",
    "cpc_cost_per_link_click": "cpc",
    "ctr_link_click_through_rate": "ctr",
    "landing_page_views": "landing_page_views",
}


class MissingSource(FileNotFoundError):
    """A required export is absent or holds no rows."""


def clean_header(header: str) -> str:
    """Lower case, separators to underscores, parentheses dropped."""
    without_brackets = re.sub(r"[()]", "", header.lower())
    return re.sub(r"[ /.:,-]", "_", without_brackets)


def clean_headers(headers: list[str]) -> list[str]:
    """Clean every header; later repeats of a name get a counter."""
    seen: dict[str, int] = {}
    out = []
    for header in map(clean_header, headers):
        n = seen.get(header, 0)
        seen[header] = n + 1
        out.append(f"{header}_{n}" if n else header)
    return out


def normalise(df: DataFrame) -> DataFrame:
    """Clean headers; NULL to blank; strip the guarding apostrophe from every value."""
    df = df.toDF(*clean_headers(df.columns))
    return df.select(
        *[
            C.drop_leading_apostrophe(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c)
            for c in df.columns
        ]
    )


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp())


def read_export(
    spark: SparkSession, path: str | list[str], multiline: bool = True, surplus: bool = False
) -> DataFrame:
    """Read comma-separated exports with a header line, every column as text.

    Quoted fields may hold line breaks; large files are split over tasks all the same (see
    ``records``). With ``surplus``, what a row has beyond the header is in ``surplus_field``.
    Exports without line breaks can be read with ``multiline=False``, which needs no exchange
    and knows no surplus.
    """
    if multiline:
        df = records.read_records(spark, path)
        named = normalise(df.toDF(*records.header_of(spark, path), records.SURPLUS))
        return named if surplus else named.drop(records.SURPLUS)
    df = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        # Files of one source must agree in their header; another order of columns is an error.
        .option("enforceSchema", False)
        .csv(path)
    )
    return normalise(df)


def read_optional(
    spark: SparkSession, path: str | list[str], multiline: bool = True, surplus: bool = False
) -> DataFrame | None:
    """Like ``read_export``, but None when the path is absent or holds no data rows."""
    try:
        df = read_export(spark, path, multiline, surplus)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no file at %s", path)
        return None
    if not set(df.columns) - {records.SURPLUS} or df.isEmpty():
        logger.warning("no rows in %s", path)
        return None
    return df


def first_found(
    spark: SparkSession, paths: list[str], multiline: bool = True, surplus: bool = False
) -> DataFrame | None:
    for path in paths:
        df = read_optional(spark, path, multiline, surplus)
        if df is not None:
            return df
    return None


def empty(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.range(0).select(*[F.lit("").alias(n) for n in names])


def ads_columns(df: DataFrame) -> DataFrame:
    """Keep the known columns of an advertising export under their short names."""
    renamed = df.withColumnsRenamed({k: v for k, v in ADS_COLUMNS.items() if k in df.columns})
    known = [c for c in [*schemas.RAW_ADS, records.SURPLUS] if c in renamed.columns]
    return renamed.select(*known)
