"""Refreshes replace all tables or none, and their writes count what checks ask."""

from __future__ import annotations

import glob
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.plans import warehouse as plan
from ledgerloom.plans.versions import ConcurrentRefresh, Refresh, expire, published, read_tables
from ledgerloom.sources.registry import ExportFolders

SCHEMA = "order_id long, line_number long, amount double"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def ids(spark, root, version=None) -> list[int]:
    return sorted(r["id"] for r in read_tables(spark, root, version)["a"].collect())


def put(spark, root, start: int, stop: int) -> int:
    refresh = Refresh(spark, root)
    refresh.save("a", spark.range(start, stop))
    return refresh.publish()


def test_nothing_is_published_before_the_first_refresh(spark, root):
    assert published(spark, root) == (0, {})
    assert read_tables(spark, root) == {}
    assert expire(spark, root) == []
    with pytest.raises(LookupError):
        published(spark, root, 3)


def test_readers_see_the_former_tables_until_publish(spark, root):
    assert put(spark, root, 0, 3) == 1
    refresh = Refresh(spark, root)
    again = refresh.save("a", spark.range(10, 15))
    refresh.save("b", spark.range(1))
    assert again.count() == 5 and ids(spark, root) == [0, 1, 2]
    assert set(read_tables(spark, root)) == {"a"}
    assert refresh.publish() == 2
    assert ids(spark, root) == list(range(10, 15)) and ids(spark, root, 1) == [0, 1, 2]
    assert set(read_tables(spark, root)) == {"a", "b"}


def test_failed_write_leaves_the_former_table(spark, root):
    put(spark, root, 0, 3)
    refresh = Refresh(spark, root)
    with pytest.raises(Exception, match="no such row"):
        refresh.save("a", spark.range(5).withColumn("x", F.raise_error(F.lit("no such row"))))
    refresh.discard()
    assert ids(spark, root) == [0, 1, 2]
    assert not glob.glob(f"{root}/versions/{refresh.name}")


def test_tables_that_a_refresh_does_not_write_stay(spark, root):
    refresh = Refresh(spark, root)
    refresh.save("a", spark.range(3))
    refresh.save("b", spark.range(7))
    refresh.publish()
    put(spark, root, 5, 6)
    tables = read_tables(spark, root)
    assert (tables["a"].count(), tables["b"].count()) == (1, 7)


def test_of_two_refreshes_at_once_one_is_published(spark, root):
    put(spark, root, 0, 1)
    one, two = Refresh(spark, root), Refresh(spark, root)
    one.save("a", spark.range(2))
    two.save("a", spark.range(3))
    two.publish()
    with pytest.raises(ConcurrentRefresh):
        one.publish()
    assert ids(spark, root) == [0, 1, 2]


def test_expire_keeps_the_newest_versions_and_what_they_name(spark, root):
    refresh = Refresh(spark, root)
    refresh.save("a", spark.range(1))
    refresh.save("b", spark.range(7))
    refresh.publish()
    for n in range(2, 5):
        put(spark, root, 0, n)
    gone = expire(spark, root, keep=2)
    assert len(gone) == 2 and all(path.endswith("/a") for path in gone)
    assert ids(spark, root, 4) == [0, 1, 2, 3] and ids(spark, root, 3) == [0, 1, 2]
    assert read_tables(spark, root)["b"].count() == 7
    with pytest.raises(LookupError):
        published(spark, root, 2)


def test_the_write_counts_rows_and_violations(spark, frame, root):
    df = frame(SCHEMA, {"order_id": 1, "amount": -1.0}, {"order_id": None, "amount": 2.0}, {"order_id": 3})
    checks = {"negative": F.col("amount") < 0, "no id": F.col("order_id").isNull(), "huge": F.col("amount") > 99}
    refresh = Refresh(spark, root)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one write", "")
    refresh.save("t", df.repartition(3), checks, named="lines")
    jobs = tracker.getJobIdsForGroup("one write")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(refresh.violations) == [("lines", "huge", 0), ("lines", "negative", 1), ("lines", "no id", 1)]
    assert refresh.entries["t"]["rows"] == 3
    assert len(jobs) <= 2  # the shuffle and the write; nothing is read again
    refresh.save("none", df.limit(0), checks)
    assert refresh.entries["none"]["rows"] == 0 and refresh.violations[-1] == ("none", "huge", 0)
    assert refresh.read("none").columns == df.columns


def test_files_are_ranges_and_a_hot_order_spans_several(spark, root):
    lines = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("line_number"),
        F.lit(20250101).alias("day"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh = Refresh(spark, root)
        refresh.save("t", lines, sorted_by=["order_id", "line_number"], month_from="day")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = glob.glob(f"{root}/{refresh.entries['t']['path']}/order_month=202501/*.parquet")
    bounds = []
    for file in files:
        data = pq.ParquetFile(file).metadata
        at = {data.schema.column(i).name: i for i in range(data.num_columns)}["order_id"]
        parts = [data.row_group(g).column(at).statistics for g in range(data.num_row_groups)]
        bounds.append((min(p.min for p in parts), max(p.max for p in parts)))
    assert sum(low <= 20_001 <= high for low, high in bounds) == 1
    assert sum(low <= 7 <= high for low, high in bounds) >= 2
    stored = refresh.read("t")
    assert stored.where("order_id = 20002").count() == 1
    assert stored.where("order_id = 7").count() == lines.where("order_id = 7").count()


def test_bad_load_leaves_all_former_tables(spark, export_folders, tmp_path):
    sample = tmp_path / "sample"
    shutil.copytree(export_folders.sample, sample)
    folders = ExportFolders(export_folders.raw, export_folders.reference, str(sample), export_folders.fallback)
    config = plan.WarehouseConfig(folders, str(tmp_path / "out"))
    plan.build_warehouse(spark, config, use_sample=True)
    orders = (sample / "sample_orders.csv").read_text()
    former = published(spark, config.root)

    bad = {
        "negative amount": orders.replace("24.90", "-24.90"),
        "blank id": orders.replace("1000000001003", ""),
    }
    for check, text in bad.items():
        assert text != orders
        (sample / "sample_orders.csv").write_text(text)
        with pytest.raises(quality.QualityError, match=check):
            plan.build_warehouse(spark, config, use_sample=True)
        assert published(spark, config.root) == former
    (sample / "sample_orders.csv").write_text(orders.replace("10.50", "ten"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        plan.build_warehouse(spark, config, use_sample=True)
    assert published(spark, config.root) == former
    tables = plan.read_warehouse(spark, config)
    assert tables["fact_order"].count() == 5 and tables["kpi_revenue_totals"].first()["total_orders"] == 5
    assert len(glob.glob(f"{config.root}/versions/*")) == 1

    allowed = plan.WarehouseConfig(folders, config.root, allowed_checks=quality.REPORTED_ONLY | {"blank id"})
    (sample / "sample_orders.csv").write_text(bad["blank id"])
    assert plan.build_warehouse(spark, allowed, use_sample=True)["fact_order"].count() == 4
    assert plan.read_warehouse(spark, config, former[0])["fact_order"].count() == 5


def test_views_hold_every_export(spark, warehouse):
    plan.register_views(warehouse, "all_")
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("all_export_")}
    assert len(names) == 11
    assert spark.sql("SELECT * FROM all_export_dim_customer").columns[0] == "customer_key"
    assert "loaded_at" in warehouse["stg_orders"].columns
