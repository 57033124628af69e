"""Helpers that the operators of this package share."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, one temporary folder per process; only on a single machine,
    since executors elsewhere would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="ledgerloom-"))
    return f"file://{_OWN_FOLDER[0]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder, and read back.

    It cuts the lineage as a checkpoint does: what is lost with an executor is read again
    from the folder and not computed again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, marked for broadcast if a count shows that it has ``rows`` rows at most.

    Beyond that it is left to Spark, which shuffles both sides and splits hot keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def worker_tool(key: Hashable, make: Callable):
    """What ``make`` returns, kept by this Python worker for all tasks that ask for ``key``.

    A worker keeps one tool at a time: the next operator's tool takes the place of the last
    one's, so that caches of several operators never add up.
    """
    shelf = sys.modules.setdefault("_ledgerloom_tool", types.ModuleType("_ledgerloom_tool")).__dict__
    if shelf.get("held_key") != key:
        shelf.pop("held", None)
        shelf["held"], shelf["held_key"] = make(), key
    return shelf["held"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
