"""Projections that leave the warehouse: allow-listed columns, no personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------------------

FORBIDDEN = ["email", "first_name", "last_name", "phone"]

FACT_ORDERS = [
    "order_key", "order_id", "order_number", "order_date_key", "customer_key", "channel_key",
    "shipping_method_key", "gross_product_sales", "order_discount_amount", "subtotal",
    "shipping_amount", "tax_amount", "total_amount", "refunded_amount", "net_sales",
    "line_item_count", "unit_count", "financial_status", "fulfillment_status", "risk_level",
    "created_at", "paid_at", "fulfilled_at",
]
FACT_ORDER_LINES = [
    "order_line_key", "order_key", "order_id", "line_number", "product_key", "order_date_key",
    "quantity", "unit_price", "gross_line_revenue", "line_discount",
    "allocated_order_discount", "net_line_revenue", "estimated_cogs", "has_missing_cost",
    "gross_margin", "margin_percent",
]
DIM_PRODUCT = [
    "product_key", "internal_sku", "product_handle", "product_title", "size_ml", "recipe_id",
    "product_category", "vendor", "variant_price", "is_active",
]
DIM_CUSTOMER = [
    "customer_key", "customer_id_hash", "city", "province", "province_code", "country",
    "country_code", "accepts_email_marketing", "accepts_sms_marketing", "first_order_date",
    "total_orders", "total_spent", "customer_segment",
]
KPI_SUMMARY = [
    "total_orders", "total_units_sold", "total_gross_product_sales", "total_discounts",
    "total_refunds", "total_net_sales", "refund_rate_percent", "overall_aov",
    "orders_with_discount", "discount_usage_rate_percent",
]
FACT_SEO_DAILY = ["gsc_daily_key", "date_key", "clicks", "impressions", "ctr", "avg_position"]


class PersonalDataError(ValueError):
    """An export would contain a forbidden column."""


def forbidden_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower() in FORBIDDEN]


def guard(df: DataFrame, name: str) -> DataFrame:
    """Return the export unchanged, or raise if it has a forbidden column."""
    found = forbidden_columns(df)
    if found:
        raise PersonalDataError(f"{name} would export {found}")
    return df


def fact_orders(fact_order: DataFrame) -> DataFrame:
    return guard(fact_order.select(*FACT_ORDERS), "fact_orders")


def fact_order_lines(fact_order_line: DataFrame) -> DataFrame:
    return guard(fact_order_line.select(*FACT_ORDER_LINES), "fact_order_lines")


def dim_product(dim: DataFrame) -> DataFrame:
    return guard(dim.select(*DIM_PRODUCT), "dim_product")


def dim_customer(dim: DataFrame) -> DataFrame:
    return guard(dim.select(*DIM_CUSTOMER), "dim_customer")


def whole(table: DataFrame, name: str) -> DataFrame:
    """Tables exported with all columns: calendar, channels, shipping, materials, marketing."""
    return guard(table, name)


def kpi_summary(revenue_totals: DataFrame) -> DataFrame:
    return guard(
        revenue_totals.select(F.lit("all_time").alias("period"), *KPI_SUMMARY), "kpi_summary"
    )


def fact_seo_daily(fact_search: DataFrame) -> DataFrame:
    return guard(fact_search.select(*FACT_SEO_DAILY), "fact_seo_daily")


def all_exports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every export, from the tables of ``plans.warehouse``."""
    return {
        "fact_orders": fact_orders(tables["fact_order"]),
        "fact_order_lines": fact_order_lines(tables["fact_order_line"]),
        "dim_date": whole(tables["dim_date"], "dim_date"),
        "dim_product": dim_product(tables["dim_product"]),
        "dim_customer": dim_customer(tables["dim_customer"]),
        "dim_channel": whole(tables["dim_channel"], "dim_channel"),
        "dim_shipping_method": whole(tables["dim_shipping_method"], "dim_shipping_method"),
        "dim_material": whole(tables["dim_material"], "dim_material"),
        "kpi_summary": kpi_summary(tables["kpi_revenue_totals"]),
        "fact_marketing": whole(tables["fact_marketing_spend"], "fact_marketing"),
        "fact_seo_daily": fact_seo_daily(tables["fact_gsc_daily"]),
    }
