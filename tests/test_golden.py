"""From text exports to marts: values worked out by hand for a five-order shop."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal as Dec

import pytest

from ledgerloom.operators import exports, marts, quality
from ledgerloom.plans import warehouse as plan
from ledgerloom.sources.csv import MissingSource
from ledgerloom.sources.registry import ExportFolders


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_revenue_totals(warehouse):
    r = one(warehouse["kpi_revenue_totals"])
    assert (r["total_orders"], r["total_units_sold"], r["orders_with_discount"]) == (5, 6, 1)
    assert r["total_gross_product_sales"] == Dec("63.00")
    assert r["total_discounts"] == Dec("2.62")
    assert r["total_refunds"] == 0
    assert r["total_net_sales"] == Dec("60.38")
    assert r["refund_rate_percent"] == 0
    assert r["overall_aov"] == pytest.approx(12.076)
    assert r["discount_usage_rate_percent"] == pytest.approx(20)


def test_margins_per_line(warehouse):
    lines = by(warehouse["fact_order_line"], "order_id")
    margins = [lines[1000000000000 + n]["gross_margin"] for n in range(1001, 1006)]
    assert margins == [Dec(x) for x in ("8.78", "6.16", "8.78", "8.78", "8.78")]
    percents = {n: lines[1000000000000 + n]["margin_percent"] for n in (1001, 1002, 1003)}
    assert percents == {1001: Dec("83.6190"), 1002: Dec("78.1726"), 1003: Dec("83.6190")}
    assert {r["estimated_cogs"] for r in lines.values()} == {Dec("1.72")}
    assert all(r["has_missing_cost"] for r in lines.values())
    assert lines[1000000001002]["allocated_order_discount"] == Dec("2.62")
    assert lines[1000000001002]["net_line_revenue"] == Dec("7.88")


def test_cogs_detail_rows(warehouse):
    assert warehouse["fact_cogs_estimate"].count() == 30
    assert warehouse["fact_cogs_estimate"].select("cogs_key").distinct().count() == 30


def test_product_profitability(warehouse):
    rows = by(warehouse["kpi_product_profitability"], "internal_sku")
    sold, unsold = rows["CEDAR_2_5ML"], rows["CEDAR_1_5ML"]
    assert (sold["orders_containing_product"], sold["units_sold"]) == (5, 6)
    assert sold["gross_revenue"] == Dec("63.00")
    assert sold["allocated_order_discounts"] == Dec("2.62")
    assert sold["net_revenue"] == Dec("60.38")
    assert sold["total_estimated_cogs"] == Dec("10.32")
    assert sold["total_gross_margin"] == Dec("50.06")
    assert sold["margin_percent"] == pytest.approx(82.90824776)
    assert sold["avg_selling_price"] == pytest.approx(10.0633333)
    assert sold["cogs_status"] == marts.COGS_INCOMPLETE
    assert unsold["orders_containing_product"] == 0
    assert unsold["units_sold"] is None and unsold["has_missing_cost"] is None
    assert (unsold["margin_percent"], unsold["avg_selling_price"]) == (0, 0)
    assert unsold["cogs_status"] == marts.COGS_COMPLETE
    first = warehouse["kpi_product_profitability"].first()
    assert first["internal_sku"] == "CEDAR_2_5ML"


def test_cogs_detail(warehouse):
    rows = by(warehouse["kpi_cogs_detail"], "material_name")
    totals = {k: r["total_cost"] for k, r in rows.items()}
    assert totals == {
        "Carrier": Dec("1.00"), "Scent A": Dec("2.50"), "Scent B": Dec("2.50"), "Aroma X": 0,
        "Bottles": Dec("2.50"), "Labels": Dec("0.10"),
    }
    assert rows["Carrier"]["total_ml_used"] == 20
    assert rows["Carrier"]["avg_amount_ml_per_unit"] == 4.0
    assert rows["Bottles"]["avg_amount_ml_per_unit"] is None


def test_customer_marts(warehouse):
    segments = by(warehouse["kpi_customer_segments"], "customer_segment")
    new, returning = segments["new"], segments["returning"]
    assert (new["customer_count"], new["total_orders"], new["total_revenue"]) == (3, 3, Dec("39.38"))
    assert (returning["customer_count"], returning["total_orders"]) == (1, 2)
    assert returning["total_revenue"] == Dec("21.00")
    kinds = by(warehouse["kpi_new_vs_returning"], "customer_type")
    assert (kinds["new"]["orders"], kinds["new"]["unique_customers"]) == (4, 4)
    assert kinds["new"]["revenue"] == Dec("49.88")
    assert (kinds["returning"]["orders"], kinds["returning"]["revenue"]) == (1, Dec("10.50"))
    repeat = one(warehouse["kpi_repeat_purchase_rate"])
    assert (repeat["total_customers_with_orders"], repeat["one_time_customers"]) == (4, 3)
    assert repeat["repeat_customers"] == 1
    assert repeat["repeat_purchase_rate_percent"] == 25
    assert repeat["avg_orders_per_customer"] == 1.25
    assert repeat["avg_lifetime_value"] == pytest.approx(15.095)


def test_shipping_and_validation(warehouse):
    methods = by(warehouse["kpi_shipping_methods"], "shipping_method_name")
    economy, local = methods["Economy"], methods["Local Delivery"]
    assert (economy["order_count"], economy["revenue"]) == (4, Dec("49.88"))
    assert economy["shipping_collected"] == Dec("15.60") and not economy["is_local_delivery"]
    assert (local["order_count"], local["revenue"], local["shipping_collected"]) == (1, Dec("10.50"), 0)
    assert local["is_local_delivery"]
    checks = warehouse["validation_order_totals"].collect()
    assert len(checks) == 5
    assert {(r["subtotal_validation"], r["total_validation"]) for r in checks} == {("PASS", "PASS")}


def test_calendar_and_daily_sales(warehouse):
    assert warehouse["dim_date"].count() == 1095
    daily = marts.kpi_sales_summary(
        warehouse["dim_date"], warehouse["fact_order"], dt.date(2025, 12, 2)
    ).collect()
    assert daily[0]["full_date"] == dt.date(2025, 12, 2)
    assert (daily[0]["orders_count"], daily[0]["net_sales"], daily[0]["aov"]) == (0, None, 0)
    assert (daily[1]["orders_count"], daily[1]["net_sales"]) == (1, Dec("10.50"))
    assert len(daily) == 336


def test_customer_is_hashed(warehouse):
    hashes = {r["customer_id_hash"] for r in warehouse["dim_customer"].collect()}
    assert hashlib.sha256(b"ann@example.com").hexdigest() in hashes
    assert len(hashes) == 4


def test_zip_and_text_survive(warehouse):
    rows = by(warehouse["stg_orders"], "order_number")
    assert rows["#T1001"]["billing_zip"] == "07001"
    assert rows["#T1001"]["created_at"] == dt.datetime(2025, 10, 15, 14, 0)
    assert rows["#T1001"]["discount_code"] is None
    raw = by(warehouse["raw.orders"], "name")
    assert raw["#T1001"]["notes"] == 'line one\nsays "hi", twice'
    assert "loaded_at" in warehouse["raw.orders"].columns


def test_ads_and_search(warehouse):
    ads = by(warehouse["kpi_marketing_performance"], "campaign_name")
    assert ads["Autumn"]["amount_spent"] == Dec("1234.50")
    assert (ads["Autumn"]["cpm"], ads["Autumn"]["ctr"]) == (Dec("914.4444"), Dec("2.0000"))
    assert ads["Autumn"]["estimated_roas"] is None
    assert (ads["Winter"]["amount_spent"], ads["Winter"]["link_clicks"]) == (0, None)
    search = warehouse["kpi_seo_performance"].collect()
    assert [r["full_date"] for r in search] == [dt.date(2025, 10, 16), dt.date(2025, 10, 15)]
    assert search[1]["ctr"] == Dec("0.0750")


def test_summary(warehouse):
    assert one(plan.load_summary(warehouse)) == {
        "orders": 5, "line_items": 5, "customers": 4, "products": 2, "revenue": Dec("60.38"),
        "units": 6,
    }


def test_quality_report(spark, warehouse):
    raw = {k.removeprefix("raw."): v for k, v in warehouse.items() if k.startswith("raw.")}
    tables = {k: v for k, v in warehouse.items() if not k.startswith(("raw.", "kpi"))}
    report = quality.dq_report(raw, tables, exports.all_exports(warehouse)).cache()
    assert report.where("violations > 0").collect() == []
    assert report.count() > 100
    quality.require_clean(report)
    report.unpersist()


def test_exports_are_written_without_personal_data(spark, warehouse, tmp_path):
    paths = plan.write_exports(warehouse, str(tmp_path / "parquet"))
    assert len(paths) == 11
    columns = {p.rsplit("/", 1)[1]: spark.read.parquet(p).columns for p in paths}
    assert columns["fact_orders"] == exports.FACT_ORDERS
    assert len(columns["fact_orders"]) == 23 and len(columns["fact_order_lines"]) == 16
    assert "customer_id" not in columns["dim_customer"]
    for name in columns.values():
        assert not set(name) & set(exports.FORBIDDEN)
    plan.write_exports(warehouse, str(tmp_path / "csv"), "csv")
    summary = spark.read.csv(str(tmp_path / "csv/kpi_summary"), header=True).first()
    assert (summary["period"], summary["total_orders"]) == ("all_time", "5")


def test_views(spark, warehouse):
    plan.register_views(warehouse, "shop_")
    row = spark.sql("SELECT total_orders FROM shop_kpi_revenue_totals").first()
    assert row["total_orders"] == 5
    assert spark.sql("SELECT count(*) AS n FROM shop_raw_orders").first()["n"] == 5


def test_build_again_from_loaded_layer(spark, export_folders, tmp_path):
    config = plan.WarehouseConfig(export_folders, str(tmp_path))
    loaded = plan.build_warehouse(spark, config, "load", use_sample=True)
    assert set(loaded) == {f"raw.{s.table}" for s in plan.SOURCES}
    for _ in range(2):  # a refresh replaces what is there
        built = plan.build_warehouse(spark, config, "build")
        assert built["fact_order"].count() == 5
    with pytest.raises(ValueError):
        plan.build_warehouse(spark, config, "other")


def test_missing_sources(spark, export_folders, tmp_path):
    empty = ExportFolders(str(tmp_path / "none"), str(tmp_path / "none"))
    with pytest.raises(MissingSource):
        plan.load_raw(spark, empty)
    folders = ExportFolders(str(tmp_path / "none"), export_folders.reference, export_folders.sample)
    raw = plan.load_raw(spark, folders, use_sample=True)
    assert raw["meta_ads"].count() == 0 and "amount_spent" in raw["meta_ads"].columns
    assert raw["gsc_daily"].count() == 0
    assert raw["recipes"].count() == 10  # from the shared reference folder
