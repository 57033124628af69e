"""Declared keys, references and text lengths of the layers.

The data-quality checks are generated from these tables. They state fixed values: column
names and lengths that consumers of the warehouse rely on.
"""

from __future__ import annotations

# ---- columns a source must offer, used to type an absent optional source --------------

RAW_ADS = [
    "campaign_name", "reach", "frequency", "impressions", "cpm", "amount_spent",
    "link_clicks", "cpc", "ctr", "landing_page_views",
]
RAW_SEARCH = ["date", "clicks", "impressions", "ctr", "position"]

# ---- types that staging gives the text columns of the raw tables -----------------------

_MONEY, _RATE = "decimal(18,2)", "decimal(10,4)"
RAW_TYPES = {
    "orders": {
        "id": "bigint", "subtotal": _MONEY, "shipping": _MONEY, "taxes": _MONEY, "total": _MONEY,
        "discount_amount": _MONEY, "refunded_amount": _MONEY, "created_at": "timestamp",
        "paid_at": "timestamp", "fulfilled_at": "timestamp", "cancelled_at": "timestamp",
        "lineitem_quantity": "int", "lineitem_price": _MONEY, "lineitem_compare_at_price": _MONEY,
        "lineitem_discount": _MONEY,
    },
    "products": {
        "variant_price": _MONEY, "variant_compare_at_price": _MONEY, "variant_inventory_qty": "int",
    },
    "customers": {"id": "bigint", "customer_id": "bigint", "total_spent": _MONEY, "total_orders": "int"},
    "product_sku_map": {"size_ml": "int"},
    "material_costs": {"cost_per_unit": _RATE, "cost_per_ml": _RATE},
    "recipes": {"batch_size_ml": "int", "percent": _RATE, "amount_ml": _RATE},
    "meta_ads": {
        "reach": "bigint", "frequency": _RATE, "impressions": "bigint", "cpm": _RATE,
        "link_clicks": "bigint", "cpc": _RATE, "ctr": _RATE, "landing_page_views": "bigint",
        "amount_spent": _MONEY,
    },
    "gsc_daily": {"date": "date", "clicks": "bigint", "impressions": "bigint", "position": _MONEY, "ctr": _MONEY},
}
# Columns whose text is cleaned before it is typed.
WITH_CURRENCY_SIGN = {"amount_spent", "amount_spent_usd"}
WITH_PERCENT_SIGN = {("gsc_daily", "ctr")}

# ---- keys -----------------------------------------------------------------------------

UNIQUE_KEYS = {
    "stg_orders": ["order_id"],
    "stg_products": ["handle"],
    "stg_customers": ["customer_id"],
    "stg_product_sku_map": ["internal_sku"],
    "stg_material_costs": ["material_id"],
    "dim_date": ["date_key"],
    "dim_product": ["internal_sku"],
    "dim_customer": ["customer_id_hash"],
    "dim_channel": ["channel_code"],
    "dim_shipping_method": ["shipping_method_code"],
    "dim_material": ["material_id"],
    "fact_order": ["order_id"],
    "fact_order_line": ["order_line_key"],
}

# child table, child column -> parent table, parent column
REFERENCES = [
    ("stg_order_lines", "order_id", "stg_orders", "order_id"),
    ("fact_order", "order_date_key", "dim_date", "date_key"),
    ("fact_order", "customer_key", "dim_customer", "customer_key"),
    ("fact_order", "channel_key", "dim_channel", "channel_key"),
    ("fact_order", "shipping_method_key", "dim_shipping_method", "shipping_method_key"),
    ("fact_order_line", "order_key", "fact_order", "order_key"),
    ("fact_order_line", "product_key", "dim_product", "product_key"),
    ("fact_order_line", "order_date_key", "dim_date", "date_key"),
    ("fact_cogs_estimate", "order_line_key", "fact_order_line", "order_line_key"),
    ("fact_cogs_estimate", "product_key", "dim_product", "product_key"),
    ("fact_cogs_estimate", "material_key", "dim_material", "material_key"),
    ("fact_gsc_daily", "date_key", "dim_date", "date_key"),
]

NOT_NULL = {
    "stg_orders": ["order_id"],
    "stg_order_lines": ["order_id"],
    "stg_customers": ["customer_id"],
    "dim_date": ["date_key", "full_date"],
    "dim_product": ["internal_sku"],
    "dim_customer": ["customer_id_hash"],
    "dim_channel": ["channel_code"],
    "dim_shipping_method": ["shipping_method_code"],
    "dim_material": ["material_id"],
    "fact_order": ["order_id"],
}

# ---- fixed values: longest text each column may hold ----------------------------------

MAX_LENGTH = {
    "stg_orders": {
        "order_number": 50, "email": 255, "financial_status": 50, "fulfillment_status": 50,
        "currency": 10, "discount_code": 100, "shipping_method": 100, "risk_level": 20,
        "source": 50, "payment_method": 100, "billing_city": 100, "billing_province": 50,
        "billing_country": 10, "billing_zip": 20, "shipping_city": 100,
        "shipping_province": 50, "shipping_country": 10, "shipping_zip": 20,
    },
    "stg_order_lines": {
        "order_number": 50, "lineitem_name": 500, "lineitem_sku": 100,
        "lineitem_fulfillment_status": 50, "vendor": 255,
    },
    "stg_products": {
        "handle": 255, "title": 500, "vendor": 255, "product_category": 500,
        "product_type": 100, "variant_sku": 100, "status": 20,
    },
    "stg_customers": {
        "first_name": 100, "last_name": 100, "email": 255, "city": 100, "province": 100,
        "province_code": 10, "country": 100, "country_code": 10, "zip": 20,
    },
    "stg_product_sku_map": {
        "internal_sku": 50, "lineitem_name": 500, "product_handle": 255, "recipe_id": 50,
        "product_category": 100,
    },
    "stg_material_costs": {
        "material_id": 50, "material_name": 255, "ingredient_match": 255, "category": 100,
        "unit": 20, "supplier": 100,
    },
    "stg_recipes": {
        "recipe_id": 50, "recipe_name": 100, "variant": 100, "ingredient_match": 255,
        "material_id": 50,
    },
    "stg_meta_ads": {"campaign_name": 500},
}


def declared_tables() -> list[str]:
    """Tables with a NOT NULL or length rule."""
    return list(dict.fromkeys([*NOT_NULL, *MAX_LENGTH]))
