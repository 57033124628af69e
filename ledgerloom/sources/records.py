"""Text exports whose quoted fields hold line breaks, read by many tasks.

A file is read line by line, in splits. Whether a line break ends a record depends on the
quotes before it: their number is even between records and odd inside a quoted field. So each
split counts its quotes, the counts are added up over the splits of a file, and from that
start a running count inside the split tells which lines begin a record. Lines of one record
are put together, also across splits, and a record is parsed on its own.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SURPLUS = "surplus_field"
_QUOTE = '"'


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, record, text``: the records of comma-separated files, numbered from 0 in each.

    Quotes inside quoted fields are doubled. A file whose quotes don't add up stops the job.
    Line breaks inside fields stay as they are; the one that ends a record goes.
    """
    # The order of lines inside a split is fixed before any exchange. A mark for the byte
    # order is no part of the text.
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", "^﻿", "").alias("value"),
        (F.length("value") - F.length(F.replace("value", F.lit(_QUOTE), F.lit("")))).alias("quotes"),
    )

    # One row per split: quotes and records before it.
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    in_file = Window.partitionBy("file").orderBy("split")
    before = F.coalesce(F.sum("quotes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("quotes").over(Window.partitionBy("file"))
    even = F.when(total % 2 == 0, before % 2).otherwise(
        F.raise_error(F.concat(F.lit("quotes don't add up in "), "file"))
    )
    starts = splits.select("file", "split", even.alias("open"))

    in_split = Window.partitionBy("file", "split").orderBy("line")
    earlier = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.join(starts, ["file", "split"]).withColumn("begins", (F.col("open") + earlier) % 2 == 0)
    numbered = marked.withColumn("local", F.count_if("begins").over(in_split))

    # Local numbers count from 1; lines that go on from the split before have number 0.
    counts = numbered.groupBy("file", "split").agg(F.max("local").alias("records"))
    offset = F.coalesce(F.sum("records").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("file", "split", offset.alias("offset"))
    placed = numbered.join(offsets, ["file", "split"]).select(
        "file",
        (F.col("local") + F.col("offset") - 1).alias("record"),
        F.struct("split", "line", "value").alias("part"),
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "\n")
    records = placed.groupBy("file", "record").agg(whole.alias("text"))
    return records.withColumn("text", F.regexp_replace("text", "\r$", ""))


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The fields of the first line; headers hold no line breaks."""
    first = spark.read.text(path, lineSep="\n").first()
    line = first["value"].removeprefix("﻿").removesuffix("\r") if first else ""
    return next(csv.reader([line]), [])


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Exports with a header line, every column as text, plus ``surplus_field``.

    Columns are called ``c0, c1, ...`` in the order of the header; ``header_of`` has its
    names, which may repeat. All files must have the same header. A row with fewer fields has
    NULL in the rest; what a row has beyond the header is kept in ``surplus_field``.
    """
    names = header_of(spark, path)
    records = csv_records(spark, path).where("text <> ''")
    schema = ", ".join([*(f"c{i} STRING" for i in range(len(names))), f"{SURPLUS} STRING"])
    fields = F.from_csv("text", F.lit(schema), {"quote": _QUOTE, "escape": _QUOTE})
    parsed = records.select("file", "record", fields.alias("row"))
    header = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    given = F.array(*[F.coalesce(F.col(f"row.c{i}"), F.lit("")) for i in range(len(names))])
    # The header line of every file is compared and goes.
    differs = F.raise_error(F.concat(F.lit("another header in "), "file"))
    rows = parsed.where(
        F.when(F.col("record") > 0, F.lit(True)).when(given == header, F.lit(False)).otherwise(differs)
    )
    return rows.select("row.*")
