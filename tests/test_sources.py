from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from ledgerloom.functions import columns as C
from ledgerloom.operators import staging
from ledgerloom.sources import csv


@pytest.mark.parametrize(
    "header,cleaned",
    [
        ("Lineitem compare at price", "lineitem_compare_at_price"),
        ("Body (HTML)", "body_html"),
        ("Shopping / Age-Group", "shopping___age_group"),
        ("Price: v1.0", "price__v1_0"),
        ("CPM (cost per 1,000 impressions)", "cpm_cost_per_1_000_impressions"),
        ("id", "id"),
    ],
)
def test_clean_header(header, cleaned):
    assert csv.clean_header(header) == cleaned


def test_repeated_headers_stay_apart():
    assert csv.clean_headers(["A b", "a-b", "c", "a.b"]) == ["a_b", "a_b_1", "c", "a_b_2"]


def test_read_export(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Id,Zip Code,Note,Last\n1,'07001,\"two\nlines, \"\"q\"\"\",\n2,''x,\"\"\n")
    rows = csv.read_export(spark, str(path)).orderBy("id").collect()
    assert rows[0].asDict() == {"id": "1", "zip_code": "07001", "note": 'two\nlines, "q"', "last": ""}
    # One apostrophe goes, blanks and short rows become blank text.
    assert rows[1].asDict() == {"id": "2", "zip_code": "'x", "note": "", "last": ""}


def test_split_export_files(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"part_{n}.csv").write_text(f"Id,V\n{n},x\n")
    assert csv.read_export(spark, str(tmp_path / "part_*.csv"), multiline=False).count() == 2


def test_absent_and_empty_files(spark, tmp_path):
    assert csv.read_optional(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "head.csv").write_text("a,b\n")
    assert csv.read_optional(spark, str(tmp_path / "head.csv")) is None
    (tmp_path / "zero.csv").write_text("")
    assert csv.read_optional(spark, str(tmp_path / "zero.csv")) is None
    (tmp_path / "ok.csv").write_text("a,b\n1,2\n")
    found = csv.first_found(spark, [str(tmp_path / n) for n in ("none.csv", "head.csv", "ok.csv")])
    assert found.collect()[0].asDict() == {"a": "1", "b": "2"}


def test_ads_columns(frame):
    df = frame(
        "campaign_name string, amount_spent_usd string, other string, reach string",
        {"campaign_name": "x", "amount_spent_usd": "1", "other": "y", "reach": "2"},
    )
    assert csv.ads_columns(df).columns == ["campaign_name", "reach", "amount_spent"]


# ---- staging of single tables ---------------------------------------------------------

def raw_order(**values):
    base = {"id": "1", "name": "#1", "created_at": "2025-01-01 00:00:00 +0000", "subtotal": "1.00"}
    return base | values


ORDER_SCHEMA = ", ".join(
    f"{c} string"
    for c in (
        "id", "name", "discount_code", "discount_amount", "refunded_amount", *staging.PASS_THROUGH,
        *staging.ORDER_MONEY, *staging.ORDER_TIMES, "lineitem_name", "lineitem_sku",
        "lineitem_quantity", "lineitem_price", "lineitem_compare_at_price", "lineitem_discount",
        "lineitem_fulfillment_status", "vendor",
    )
)


def test_orders_keep_the_row_with_amounts(frame):
    df = frame(
        ORDER_SCHEMA,
        raw_order(subtotal="", email="b"),
        raw_order(subtotal="5.005", email="a", total="-5.005"),
        raw_order(id="2", created_at="2025-01-02 00:00:00 +0000", email="late"),
        raw_order(id="2", created_at="2025-01-01 20:00:00 -0600", email="early", discount_code="X"),
        raw_order(id=""),
        raw_order(id=None),
    )
    rows = {r["order_id"]: r for r in staging.stg_orders(df).collect()}
    assert set(rows) == {1, 2}
    # Money is rounded half away from zero; blanks of the two sums are 0.
    assert (str(rows[1]["subtotal"]), str(rows[1]["total"])) == ("5.01", "-5.01")
    assert (rows[1]["email"], rows[1]["discount_amount"], rows[1]["shipping"]) == ("a", 0, None)
    assert (rows[2]["email"], rows[2]["discount_code"]) == ("early", "X")
    # 20:00 at -0600 is the next day in UTC.
    assert rows[2]["created_at"].day == 2


def test_malformed_numbers_stop_or_vanish(frame):
    df = frame(ORDER_SCHEMA, raw_order(subtotal="1,000.00"))
    with pytest.raises(PySparkException):
        staging.stg_orders(df).collect()
    assert staging.stg_orders(df, C.typed_lenient).first()["subtotal"] is None


def test_order_lines(frame):
    df = frame(
        ORDER_SCHEMA,
        raw_order(lineitem_name="b", lineitem_price="2"),
        raw_order(lineitem_name="a", lineitem_quantity="3", lineitem_sku=""),
        raw_order(lineitem_name="a", lineitem_quantity="3", lineitem_sku=""),
        raw_order(lineitem_name=""),
        raw_order(id="", lineitem_name="x"),
    )
    rows = staging.stg_order_lines(df).orderBy("line_number").collect()
    assert [(r["line_number"], r["lineitem_name"], r["lineitem_quantity"]) for r in rows] == [
        (1, "a", 3), (2, "a", 3), (3, "b", 1),
    ]
    assert [r["order_line_id"] for r in rows] == ["1-1", "1-2", "1-3"]
    assert rows[0]["lineitem_sku"] is None and rows[0]["lineitem_discount"] == 0


def test_products(frame):
    schema = ", ".join(
        f"{c} string"
        for c in (
            "handle", "title", "vendor", "product_category", "type", "tags", "variant_sku",
            "variant_price", "variant_compare_at_price", "variant_inventory_qty", "published", "status",
        )
    )
    df = frame(
        schema,
        {"handle": "h", "title": "b", "published": "true"},
        {"handle": "h", "title": "a", "published": "True", "variant_price": "3", "variant_sku": ""},
        {"handle": "g", "title": "x", "published": None},
        {"handle": "", "title": "x"},
    )
    rows = {r["handle"]: r for r in staging.stg_products(df).collect()}
    assert set(rows) == {"h", "g"}
    assert (rows["h"]["title"], rows["h"]["is_published"], rows["h"]["variant_sku"]) == ("a", True, None)
    assert (rows["g"]["is_published"], rows["g"]["variant_inventory_qty"]) == (False, 0)


def test_customers_in_both_dialects(frame):
    common = "first_name string, last_name string, email string, accepts_email_marketing string, " \
             "accepts_sms_marketing string, total_spent string, total_orders string"
    full = frame(
        f"customer_id string, default_address_city string, default_address_province_code string, "
        f"default_address_country_code string, default_address_zip string, {common}",
        {"customer_id": "7", "default_address_province_code": "TX", "accepts_email_marketing": "YES"},
        {"customer_id": ""},
    )
    row = staging.stg_customers(full).collect()
    assert len(row) == 1
    assert (row[0]["province"], row[0]["province_code"]) == ("TX", "TX")
    assert row[0]["accepts_email_marketing"] and not row[0]["accepts_sms_marketing"]
    short = frame(
        f"id string, city string, province string, province_code string, country string, "
        f"country_code string, zip string, {common}",
        {"id": "8", "province": "Texas", "province_code": "TX", "total_orders": "3"},
    )
    row = staging.stg_customers(short).first()
    assert (row["province"], row["province_code"], row["total_orders"], row["total_spent"]) == (
        "Texas", "TX", 3, 0,
    )


def test_flags_of_reference_tables(frame):
    schema = ", ".join(
        f"{c} string"
        for c in (
            "internal_sku", "lineitem_name", "product_handle", "size_ml", "recipe_id",
            "product_category", "is_active",
        )
    )
    df = frame(
        schema,
        {"internal_sku": "a", "is_active": None}, {"internal_sku": "b", "is_active": ""},
        {"internal_sku": "c", "is_active": "TRUE", "size_ml": "5"}, {"internal_sku": ""},
    )
    active = {r["internal_sku"]: r["is_active"] for r in staging.stg_product_sku_map(df).collect()}
    assert active == {"a": True, "b": False, "c": True}


@pytest.mark.parametrize(
    "schema,row,spent",
    [
        ("campaign_name string", {}, 0),
        ("campaign_name string, amount_spent string", {"amount_spent": "$1,234.50"}, 1234.5),
        ("campaign_name string, amount_spent_usd string", {"amount_spent_usd": "7"}, 7),
        (
            "campaign_name string, amount_spent string, amount_spent_usd string",
            {"amount_spent": "", "amount_spent_usd": "8"}, 8,
        ),
    ],
)
def test_ad_spend_columns(frame, schema, row, spent):
    df = frame(schema, {"campaign_name": "x", **row}, {"campaign_name": ""})
    assert [float(r["amount_spent"]) for r in staging.stg_meta_ads(df).collect()] == [spent]


def test_repeated_campaigns_get_their_own_keys(frame):
    df = frame("campaign_name string, reach string", *[{"campaign_name": "x", "reach": "1"}] * 2)
    assert staging.stg_meta_ads(df).select("campaign_id").distinct().count() == 2


def test_search_days(frame):
    df = frame(
        "date string, clicks string, impressions string, ctr string, position string",
        {"date": "2025-10-15", "clicks": "1", "impressions": "3", "ctr": "33.33%", "position": "1.5"},
        {"date": ""},
    )
    rows = staging.stg_gsc_daily(df).collect()
    assert len(rows) == 1 and str(rows[0]["ctr"]) == "0.3333"


def test_files_of_a_source_agree_in_their_header(spark, tmp_path):
    (tmp_path / "a_1.csv").write_text("Id,Total\n1,2\n")
    (tmp_path / "a_2.csv").write_text("Total,Id\n20,10\n")
    with pytest.raises(Exception, match="header"):
        csv.read_export(spark, [str(tmp_path / "a_1.csv"), str(tmp_path / "a_2.csv")]).collect()


def test_lenient_load_takes_a_malformed_day_as_null(spark, frame):
    schema = "date string, clicks string, impressions string, ctr string, position string"
    raw = frame(schema, {"date": "2025-13-45", "clicks": "1", "impressions": "2", "ctr": "1%", "position": "3"})
    assert [r["date"] for r in staging.stg_gsc_daily(raw, C.typed_lenient).collect()] == [None]
    with pytest.raises(Exception):
        staging.stg_gsc_daily(raw).collect()
