from __future__ import annotations

import csv
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Make a DataFrame from dicts; absent columns of the schema are NULL."""
    from pyspark.sql.types import _parse_datatype_string

    def make(schema: str, *rows: dict):
        struct = _parse_datatype_string(schema)
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in struct.fields) for row in rows], struct
        )

    return make


# ---- a small shop as text exports -----------------------------------------------------

ORDER_HEADERS = [
    "Name", "Email", "Financial Status", "Paid at", "Fulfillment Status", "Fulfilled at",
    "Accepts Marketing", "Currency", "Subtotal", "Shipping", "Taxes", "Total", "Discount Code",
    "Discount Amount", "Shipping Method", "Created at", "Lineitem quantity", "Lineitem name",
    "Lineitem price", "Lineitem compare at price", "Lineitem sku",
    "Lineitem requires shipping", "Lineitem fulfillment status", "Billing Name",
    "Billing City", "Billing Zip", "Billing Province", "Billing Country", "Shipping City",
    "Shipping Zip", "Shipping Province", "Shipping Country", "Notes", "Cancelled at",
    "Payment Method", "Refunded Amount", "Vendor", "Id", "Tags", "Risk Level", "Source",
    "Lineitem discount", "Phone",
]
OIL = "Cedar Oil (5 mL)"


def _order(number, who, created, quantity, subtotal, shipping, total, method, zip_code, **more):
    return {
        "Name": f"#T{number}", "Id": str(1000000000000 + number), "Email": f"{who}@example.com",
        "Financial Status": "paid", "Fulfillment Status": "fulfilled", "Currency": "USD",
        "Created at": created, "Paid at": created, "Fulfilled at": created,
        "Subtotal": subtotal, "Shipping": shipping, "Taxes": "0.00", "Total": total,
        "Discount Amount": "0.00", "Refunded Amount": "0.00", "Shipping Method": method,
        "Lineitem quantity": quantity, "Lineitem name": OIL, "Lineitem price": "10.50",
        "Lineitem discount": "0.00", "Lineitem fulfillment status": "fulfilled",
        "Vendor": "Cedar House", "Billing Zip": zip_code, "Shipping Zip": zip_code,
        "Billing City": "Springfield", "Risk Level": "Low", "Source": "web",
        "Notes": 'line one\nsays "hi", twice', **more,
    }


ORDERS = [
    _order(1001, "ann", "2025-10-15 09:00:00 -0500", "1", "10.50", "3.90", "14.40", "Economy", "'07001"),
    _order(1002, "ben", "2025-10-20 13:00:00 -0500", "1", "7.88", "3.90", "11.78", "Economy", "'75201",
           **{"Discount Code": "OPENING", "Discount Amount": "2.62"}),
    _order(1003, "cat", "2025-11-01 15:00:00 -0600", "2", "21.00", "3.90", "24.90", "Economy", "'78701"),
    _order(1004, "dan", "2025-11-10 10:00:00 -0600", "1", "10.50", "0.00", "10.50", "Local Delivery", "'07002"),
    _order(1005, "ann", "2025-12-01 08:00:00 -0600", "1", "10.50", "3.90", "14.40", "Economy", "'07001"),
]
CUSTOMERS = [
    dict(zip(
        ["Id", "First Name", "Last Name", "Email", "Accepts Email Marketing", "City", "Province",
         "Province Code", "Country", "Country Code", "Zip", "Phone", "Accepts SMS Marketing",
         "Total Spent", "Total Orders"],
        [str(n), who.title(), "Test", f"{who}@example.com", yes, "Springfield", "Texas", "TX",
         "United States", "US", "'07001", "555", "no", spent, orders],
    ))
    for n, who, yes, spent, orders in (
        (1, "ann", "yes", "24.90", "2"), (2, "ben", "no", "11.78", "1"),
        (3, "cat", "yes", "24.90", "1"), (4, "dan", "no", "10.50", "1"),
    )
]
PRODUCTS = [
    {"Handle": "cedar-oil", "Title": OIL, "Body (HTML)": "<p>Oil, good</p>", "Vendor": "Cedar House",
     "Product Category": "Health > Oil", "Type": "Oil", "Tags": "a, b", "Published": "TRUE",
     "Variant SKU": "CEDAR_2_5ML", "Variant Inventory Qty": "25", "Variant Price": "10.50",
     "Variant Compare At Price": "", "Status": "active"},
    {"Handle": "cedar-old", "Title": "Cedar Oil, first recipe", "Body (HTML)": "", "Vendor": "Cedar House",
     "Product Category": "Health > Oil", "Type": "Oil", "Tags": "", "Published": "FALSE",
     "Variant SKU": "CEDAR_1_5ML", "Variant Inventory Qty": "0", "Variant Price": "9.99",
     "Variant Compare At Price": "", "Status": "draft"},
]
SKU_MAP = [
    {"lineitem_name": OIL, "product_handle": "cedar-oil", "internal_sku": "CEDAR_2_5ML", "size_ml": "5",
     "recipe_id": "CEDAR_2", "product_category": "Oil", "is_active": "true"},
    {"lineitem_name": "Cedar Oil, first recipe", "product_handle": "cedar-old",
     "internal_sku": "CEDAR_1_5ML", "size_ml": "5", "recipe_id": "CEDAR_1",
     "product_category": "Oil", "is_active": "false"},
]
MATERIALS = [
    dict(zip(["material_id", "material_name", "ingredient_match", "category", "unit", "cost_per_unit",
              "cost_per_ml", "has_known_cost", "supplier", "notes"], row))
    for row in (
        ("BOT", "Bottles", "Bottle", "Packaging", "piece", "0.50", "", "true", "S", ""),
        ("LBL", "Labels", "Label", "Packaging", "piece", "0.02", "", "true", "S", ""),
        ("CAR", "Carrier", "Carrier", "Oil", "ml", "", "0.05", "true", "S", ""),
        ("FRA", "Scent A", "A", "Oil", "ml", "", "1.00", "true", "S", ""),
        ("FRB", "Scent B", "B", "Oil", "ml", "", "2.00", "true", "S", ""),
        ("ARX", "Aroma X", "X", "Aroma", "ml", "", "", "false", "", "price unknown"),
    )
]
RECIPES = [
    dict(zip(["recipe_id", "recipe_name", "variant", "batch_size_ml", "ingredient_match", "percent",
              "amount_ml", "material_id"], (recipe, recipe, "final", "5", name, percent, amount, material)))
    for recipe, name, percent, amount, material in (
        ("CEDAR_2", "Carrier", "80.0", "4.0", "CAR"), ("CEDAR_2", "A", "10.0", "0.5", "FRA"),
        ("CEDAR_2", "B", "5.0", "0.25", "FRB"), ("CEDAR_2", "X", "5.0", "0.25", "ARX"),
        ("CEDAR_2", "Bottle", "", "", "BOT"), ("CEDAR_2", "Label", "", "", "LBL"),
        ("CEDAR_1", "Carrier", "85.0", "4.25", "CAR"), ("CEDAR_1", "A", "15.0", "0.75", "FRA"),
        ("CEDAR_1", "Bottle", "", "", "BOT"), ("CEDAR_1", "Label", "", "", "LBL"),
    )
]
ADS = [
    {"Campaign name": "Autumn", "Reach": "900", "Frequency": "1.5", "Impressions": "1350",
     "CPM (cost per 1,000 impressions)": "914.4444", "Amount spent (USD)": "$1,234.50",
     "Link clicks": "27", "CPC (cost per link click)": "45.7222",
     "CTR (link click-through rate)": "2.0", "Landing page views": "20", "Ignored": "x"},
    {"Campaign name": "Winter", "Reach": "10", "Impressions": "0", "Amount spent (USD)": ""},
]
SEARCH = [
    {"Date": "2025-10-15", "Clicks": "3", "Impressions": "40", "CTR": "7.5%", "Position": "12.25"},
    {"Date": "2025-10-16", "Clicks": "0", "Impressions": "0", "CTR": "0%", "Position": ""},
]


def write_csv(path, rows, headers=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, headers or list(rows[0]), restval="")
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture(scope="session")
def export_folders(tmp_path_factory):
    """Folders of a complete set of exports."""
    from ledgerloom.sources.registry import ExportFolders

    base = tmp_path_factory.mktemp("exports")
    write_csv(base / "sample/sample_orders.csv", ORDERS, ORDER_HEADERS)
    write_csv(base / "sample/sample_products.csv", PRODUCTS)
    write_csv(base / "sample/sample_customers.csv", CUSTOMERS)
    write_csv(base / "sample/sample_discounts.csv", [{"Name": "OPENING", "Value": "-25"}])
    write_csv(base / "reference/product_sku_map.csv", SKU_MAP)
    write_csv(base / "reference/material_costs.csv", MATERIALS)
    write_csv(base / "reference/recipes.csv", RECIPES)
    write_csv(base / "raw/Shop-Campaigns-2025.csv", ADS, list(ADS[0]))
    write_csv(base / "chart/shop-Performance-on-Search-2026/Chart.csv", SEARCH)
    return ExportFolders(
        raw=str(base / "raw"), reference=str(base / "reference"), sample=str(base / "sample"),
        fallback=str(base / "chart"),
    )


@pytest.fixture(scope="session")
def warehouse(spark, export_folders, tmp_path_factory):
    from ledgerloom.plans.warehouse import WarehouseConfig, build_warehouse

    config = WarehouseConfig(export_folders, str(tmp_path_factory.mktemp("warehouse")))
    return build_warehouse(spark, config, use_sample=True)
