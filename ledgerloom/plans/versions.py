"""Tables that change together: each refresh writes a folder of its own, a manifest names it last.

A manifest says for every table where its files are. It is one small file, written when all
tables of the refresh are stored and checked, so readers see either all of a refresh or none.
A refresh that fails leaves no manifest: the former tables stay as they were.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"
_ENTRIES = "refresh string, table string, path string, rows bigint"


class ConcurrentRefresh(RuntimeError):
    """Another refresh was published since this one began."""


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        found = spark.read.parquet(f"{root}/{MANIFEST}")
    except AnalysisException as error:
        # No folder yet, or one without any file.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found


def published(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, dict]]:
    """Number and entries by table of the newest manifest, or of a given one; 0 without any.

    A manifest has one row per table of the warehouse, so it may pass the driver.
    """
    manifests = _manifests(spark, root)
    if manifests is None:
        if version:
            raise LookupError(f"{root} has no version {version}")
        return 0, {}
    if version is None:
        version = manifests.agg(F.max("version")).first()[0]
    rows = manifests.where(F.col("version") == version).collect()
    if not rows:
        raise LookupError(f"{root} has no version {version}")
    return version, {r["table"]: r.asDict() for r in rows}


def read_tables(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest refresh, or of an earlier one that was kept."""
    _, entries = published(spark, root, version)
    return {name: spark.read.parquet(f"{root}/{e['path']}") for name, e in entries.items()}


class Refresh:
    """Tables being written. ``violations`` collects what their checks found, on the way."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.former, self.entries = published(spark, root)
        self.name = uuid.uuid4().hex
        self.violations: list[tuple[str, str, int]] = []

    def save(
        self,
        table: str,
        df: DataFrame,
        checks: dict[str, Column] | None = None,
        sorted_by: list[str] | None = None,
        month_from: str | None = None,
        named: str | None = None,
    ) -> DataFrame:
        """Write a table and return it as read from its files.

        The write itself counts the rows, and those that meet a condition of ``checks``.
        ``sorted_by`` gives files that are ranges of these columns, so that a lookup reads
        few of them; no value is too large for a file, since the last columns cut it.
        ``month_from`` names a yyyymmdd column to partition by month as well.
        """
        path = f"versions/{self.name}/{table}"
        order = sorted_by or []
        if month_from is not None:
            df = df.withColumn("order_month", F.floor(F.col(month_from) / 100).cast("int"))
            order = ["order_month", *order]
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        checks = checks or {}
        seen = Observation(f"{table} of {self.name}")
        counts = [F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(checks.values())]
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write
        if month_from is not None:
            writer = writer.partitionBy("order_month")
        writer.parquet(f"{self.root}/{path}")
        found = seen.get  # a plan without any row may have no counts
        for i, check in enumerate(checks):
            self.violations.append((named or table, check, found.get(f"c{i}") or 0))
        entry = {"refresh": self.name, "table": table, "path": path, "rows": found.get("rows") or 0}
        self.entries = {**self.entries, table: entry}
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    def read(self, table: str) -> DataFrame:
        """A table of this refresh, or of the former one if it wasn't written yet."""
        if table not in self.entries:
            raise LookupError(f"{self.root} has no table {table}")
        return self.spark.read.parquet(f"{self.root}/{self.entries[table]['path']}")

    def publish(self) -> int:
        """Switch readers to the tables written; those not written stay as they were."""
        version = self.former + 1
        rows = [tuple(e[c] for c in ("refresh", "table", "path", "rows")) for e in self.entries.values()]
        manifest = self.spark.createDataFrame(rows, _ENTRIES).coalesce(1)
        try:
            manifest.write.mode("error").parquet(f"{self.root}/{MANIFEST}/version={version}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise ConcurrentRefresh(f"version {version} of {self.root} is there already") from error
        return version

    def discard(self) -> None:
        """Remove the files of a refresh that is not published."""
        _delete(self.spark, f"{self.root}/versions/{self.name}")


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove tables and manifests that only versions before the last ``keep`` name."""
    manifests = _manifests(spark, root)
    if manifests is None:
        return []
    newest = manifests.agg(F.max("version")).first()[0]
    old = F.col("version") <= newest - keep
    used = {r["path"] for r in manifests.where(~old).select("path").distinct().collect()}
    rows = manifests.where(old).select("version", "path").collect()
    paths = sorted({r["path"] for r in rows} - used)
    # Manifests go first: what they name is still complete for a reader that has read one.
    for version in sorted({r["version"] for r in rows}):
        _delete(spark, f"{root}/{MANIFEST}/version={version}")
    for path in paths:
        _delete(spark, f"{root}/{path}")
    return paths


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
