"""Each check on a clean and on a violating frame."""

from __future__ import annotations

import time
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import exports, quality


def counts(report):
    return {r["check_name"]: r["violations"] for r in report.collect()}


RAW = "id string, created_at string"


def test_raw_orders(frame):
    good = {"id": "1", "created_at": "2025-01-01 00:00:00 -0500"}
    df = frame(RAW, good, {"id": "", "created_at": ""}, {"id": None, "created_at": None},
               {"id": "2", "created_at": "soon"})
    checks = quality.raw_order_checks()
    assert counts(quality.count_violations(df, "raw.orders", checks)) == {
        "blank id": 2, "blank created_at": 2, "created_at not a timestamp": 1,
    }
    clean = quality.count_violations(frame(RAW, good), "raw.orders", checks)
    assert set(counts(clean).values()) == {0}


def test_staged_orders(frame):
    schema = "created_at timestamp, subtotal decimal(10,2), total decimal(10,2), shipping decimal(10,2)"
    df = frame(schema, {"subtotal": Dec(1)}, {"shipping": Dec(-1)}, {"total": Dec(-1), "subtotal": Dec(-1)})
    assert counts(quality.count_violations(df, "stg_orders", quality.staged_order_checks())) == {
        "missing created_at": 3, "negative amount": 2,
    }


FACT = (
    "order_key long, order_id long, gross_product_sales decimal(18,2), order_discount_amount decimal(10,2), "
    "subtotal decimal(10,2), shipping_amount decimal(10,2), tax_amount decimal(10,2), "
    "total_amount decimal(10,2), net_sales decimal(10,2)"
)


def fact(n, subtotal="10.00", total="12.00", net="10.00"):
    return {
        "order_key": n, "order_id": n, "gross_product_sales": Dec("11.00"),
        "order_discount_amount": Dec("1.00"), "subtotal": Dec(subtotal), "shipping_amount": Dec("1.50"),
        "tax_amount": Dec("0.50"), "total_amount": Dec(total), "net_sales": Dec(net),
    }


def test_order_sums(frame):
    checks = quality.fact_order_checks()
    bad = frame(FACT, fact(1), fact(2, subtotal="10.02", total="12.02"), fact(3, total="11.98"),
                fact(4, subtotal="10.01", total="12.00"), fact(5, net="-0.01"))
    assert counts(quality.count_violations(bad, "fact_order", checks)) == {
        "subtotal differs": 1, "total differs": 1, "negative net sales": 1,
    }


def test_line_sums(frame):
    orders = frame(FACT, fact(1), fact(2), fact(3))
    lines = frame(
        "order_key long, gross_line_revenue decimal(18,2)",
        {"order_key": 1, "gross_line_revenue": Dec("5.00")}, {"order_key": 1, "gross_line_revenue": Dec("6.01")},
        {"order_key": 2, "gross_line_revenue": Dec("11.02")},
    )
    rows = quality.line_sum_gaps(orders, lines).collect()
    assert [(r["order_id"], r["diff"]) for r in rows] == [(2, Dec("0.02"))]


def test_keys(frame):
    df = frame("k long", {"k": 1}, {"k": 1}, {"k": 2}, {"k": None}, {"k": None})
    assert [(r["k"], r["count"]) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert counts(quality.unique_key(df, "t", ["k"])) == {"duplicate k": 1}


def test_references(frame):
    child = frame("c long", {"c": 1}, {"c": 9}, {"c": 9}, {"c": None})
    parent = frame("p long", {"p": 1})
    rows = quality.broken_references(child, "c", parent, "p").collect()
    assert [(r["value"], r["count"]) for r in rows] == [(9, 2)]
    tables = {
        "fact_order": frame("order_date_key int, customer_key string", {"order_date_key": 20300101}),
        "dim_date": frame("date_key int", {"date_key": 20250101}),
    }
    report = quality.referential(tables)
    assert counts(report) == {"order_date_key without dim_date": 1}


def test_unmapped_lines(frame):
    lines = frame("lineitem_name string", *[{"lineitem_name": x} for x in ("a", "b", "b")])
    skus = frame("lineitem_name string, internal_sku string", {"lineitem_name": "a", "internal_sku": "s"})
    rows = quality.unmapped_lines(lines, skus).collect()
    assert [(r["lineitem_name"], r["line_count"]) for r in rows] == [("b", 2)]


def test_sku_without_recipe(frame):
    df = frame("recipe_id string", {"recipe_id": "r"}, {"recipe_id": ""}, {"recipe_id": None})
    assert counts(quality.count_violations(df, "stg_product_sku_map", quality.sku_map_checks())) == {"no recipe": 2}


def test_costs(frame):
    lines = frame(
        "order_line_key string, estimated_cogs decimal(18,4), has_missing_cost boolean",
        {"order_line_key": "1-1", "estimated_cogs": Dec("-1"), "has_missing_cost": False},
        {"order_line_key": "1-2", "estimated_cogs": Dec("1"), "has_missing_cost": True},
        {"order_line_key": "1-3", "estimated_cogs": Dec("1"), "has_missing_cost": False},
    )
    assert counts(quality.count_violations(lines, "l", quality.fact_line_checks())) == {"negative cost": 1}
    cogs = frame(
        "order_line_key string, has_known_cost boolean",
        {"order_line_key": "1-1", "has_known_cost": False}, {"order_line_key": "1-1", "has_known_cost": False},
        {"order_line_key": "1-2", "has_known_cost": False}, {"order_line_key": "1-3", "has_known_cost": True},
    )
    rows = quality.wrong_cost_flags(lines, cogs).collect()
    assert [(r["order_line_key"], r["unknown_count"]) for r in rows] == [("1-1", 2)]


def test_hashes(frame):
    df = frame("customer_id_hash string", {"customer_id_hash": "x"}, {"customer_id_hash": ""}, {})
    assert counts(quality.count_violations(df, "dim_customer", quality.customer_checks())) == {"no hash": 2}


def test_declared_rules(frame):
    schema = "campaign_name string"
    df = frame(schema, {"campaign_name": "x" * 501}, {"campaign_name": "x" * 500}, {})
    checks = quality.declared_checks("stg_meta_ads")
    assert counts(quality.count_violations(df, "stg_meta_ads", checks)) == {"campaign_name longer than 500": 1}
    assert "order_id is null" in quality.declared_checks("stg_orders")
    assert set(schemas.NOT_NULL) - set(schemas.UNIQUE_KEYS) == {"stg_order_lines"}


def test_rejected_values(frame):
    schema = "date string, clicks string, impressions string, position string, ctr string"
    rows = [
        {"date": "2025-01-02", "clicks": "3", "impressions": "9", "position": "1.5", "ctr": "33.3%"},
        {"date": "2 Jan", "clicks": "", "impressions": "many", "position": None, "ctr": "-"},
        {"date": "2025-02-30", "clicks": "1e", "impressions": "9", "position": "1.5", "ctr": "%"},
    ]
    df = frame(schema, *rows)
    assert counts(quality.rejected_values(df, "raw.gsc_daily")) == {
        "date is not date": 2, "clicks is not bigint": 1, "impressions is not bigint": 1,
        "position is not decimal(18,2)": 0, "ctr is not decimal(18,2)": 1,
    }
    reasons = [r["why"] for r in df.select(quality.reject_reasons("gsc_daily", df.columns).alias("why")).collect()]
    assert reasons[0] is None
    assert reasons[1] == [
        "date is not date: 2 Jan", "impressions is not bigint: many", "ctr is not decimal(18,2): -"
    ]
    assert reasons[2] == ["date is not date: 2025-02-30", "clicks is not bigint: 1e"]
    other = df.select(quality.reject_reasons("discounts", df.columns).alias("why")).collect()
    assert [r["why"] for r in other] == [None] * 3


def test_empty_tables(frame):
    report = quality.empty_tables({"a": frame("x int"), "b": frame("x int", {"x": 1})})
    assert {r["table_name"]: r["violations"] for r in report.collect()} == {"a": 1, "b": 0}


def test_personal_data(frame):
    df = frame("city string, n int", {"city": "me@here.com"}, {"city": "Rome"}, {"city": None})
    row = quality.personal_data({"t": df}).first()
    assert (row["violations"], row["forbidden_columns"]) == (1, 0)
    with_email = frame("Email string", {"Email": "x"})
    assert quality.personal_data({"t": with_email}).first()["forbidden_columns"] == 1
    with pytest.raises(exports.PersonalDataError):
        exports.whole(with_email, "t")


def test_address_search_is_linear(frame):
    """A text of one long word, without an @ or with one at its end, is not searched from each place."""
    long = "a" * 400_000
    cases = {
        "me@here.com": True, "a@b.c": True, "x@@b.c": False, "a@.c": False, "a@b.": False, "@b.c": False,
        "a @b.c": False, "a@b c.d": False, "a@b@c.d": True, "a@b..c": True, "": False, long: False,
        long + "@": False, long + "@b.c": True,
    }
    df = frame("n int, t string", *[{"n": i, "t": t} for i, t in enumerate(cases)], {"n": len(cases)})
    started = time.monotonic()
    rows = df.select("n", quality.looks_like_address(F.col("t")).alias("found")).orderBy("n").collect()
    assert [r["found"] for r in rows] == [*cases.values(), None]
    assert time.monotonic() - started < 20


def test_require_clean(frame):
    report = frame(
        "table_name string, check_name string, violations long",
        {"table_name": "t", "check_name": "a", "violations": 3}, {"table_name": "t", "check_name": "b", "violations": 0},
    )
    with pytest.raises(quality.QualityError, match="t: a \\(3\\)"):
        quality.require_clean(report)
    quality.require_clean(report, allowed={"a"})


KEYED = "order_id long, handle string, internal_sku string, customer_id long"


@pytest.mark.parametrize("one_hash", [False, True])
def test_declared_keys_in_two_steps(frame, monkeypatch, one_hash):
    """Keys that share a hash are told apart; NULL keys never clash."""
    from pyspark.sql import functions as F

    if one_hash:
        monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    orders = frame(KEYED, *[{"order_id": n} for n in (1, 2, 2, 3, 3, 3, None, None)])
    products = frame(KEYED, {"handle": "a"}, {"handle": "b"}, {"handle": None})
    skus = frame(KEYED, {"internal_sku": "x"}, {"internal_sku": "x"}, {"internal_sku": "X"})
    tables = {"stg_orders": orders, "stg_products": products, "stg_product_sku_map": skus}
    report = quality.unique_keys(tables)
    assert report.columns == quality.REPORT_COLUMNS
    assert {(r["table_name"], r["check_name"]): r["violations"] for r in report.collect()} == {
        ("stg_orders", "duplicate order_id"): 2,
        ("stg_products", "duplicate handle"): 0,
        ("stg_product_sku_map", "duplicate internal_sku"): 1,
    }
    for name, df in tables.items():
        single = quality.unique_key(df, name, schemas.UNIQUE_KEYS[name]).first()
        assert single["violations"] == {r["table_name"]: r["violations"] for r in report.collect()}[name]


def test_references_are_counted_together(frame):
    child = "order_id long, order_date_key int, customer_key string, channel_key string, shipping_method_key string"
    orders = frame(child, {"order_id": 1, "order_date_key": 5, "customer_key": "a"},
                   {"order_id": 2, "order_date_key": 6, "customer_key": "a"},
                   {"order_id": 3, "order_date_key": 6, "customer_key": "b", "channel_key": "x"}, {"order_id": 4})
    tables = {
        "fact_order": orders,
        "dim_date": frame("date_key int", {"date_key": 5}),
        "dim_customer": frame("customer_key string", {"customer_key": "b"}),
        "dim_channel": frame("channel_key string"),
        "stg_orders": frame("order_id long", {"order_id": 1}),
        "stg_order_lines": frame("order_id long", *[{"order_id": 9}] * 3, {"order_id": 1}),
        "fact_gsc_daily": frame("date_key int"),
    }
    assert counts(quality.referential(tables)) == {
        "order_id without stg_orders": 3, "order_date_key without dim_date": 2,
        "customer_key without dim_customer": 2, "channel_key without dim_channel": 1,
        "date_key without dim_date": 0,
    }
