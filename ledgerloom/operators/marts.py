"""KPI marts over the star schema.

Facts are aggregated on their own key before they meet a dimension, so the joins see one
row per day, product or method. ``fact_order`` and ``dim_customer`` have one row per key
(see ``schemas.UNIQUE_KEYS``), so counting their rows counts orders and customers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.hotkeys import SHARES, join_busy
from ledgerloom.operators.facts import product_ingredients

# ---- fixed values ---------------------------------------------------------------------

TOLERANCE = "0.01"
COGS_COMPLETE = "COGS complete"
COGS_INCOMPLETE = "COGS incomplete - some ingredients missing costs"

SALES_SUMS = {
    "gross_product_sales": "gross_product_sales",
    "discounts_total": "order_discount_amount",
    "refunds_total": "refunded_amount",
    "net_sales": "net_sales",
    "shipping_collected": "shipping_amount",
    "taxes_collected": "tax_amount",
    "total_collected": "total_amount",
}


def sales_aggregates() -> list[Column]:
    """Order count, units and the seven money sums of a group of orders."""
    return [
        F.count("order_id").alias("orders_count"),
        F.sum("unit_count").alias("units_sold"),
        *[F.sum(column).alias(name) for name, column in SALES_SUMS.items()],
    ]


def sales_averages() -> list[Column]:
    return [
        C.ratio(F.col("net_sales"), F.col("orders_count")).alias("aov"),
        C.ratio(F.col("units_sold"), F.col("orders_count")).alias("avg_units_per_order"),
    ]


# ---- sales ----------------------------------------------------------------------------

def kpi_sales_summary(
    dim_date: DataFrame, fact_orders: DataFrame, as_of: dt.date | Column | None = None
) -> DataFrame:
    """Sales per calendar day up to ``as_of`` (today), newest first; empty days stay."""
    limit = F.current_date() if as_of is None else F.lit(as_of)
    # The limit reaches the scan of the orders, and their partitions by month.
    until = F.date_format(limit, "yyyyMMdd").cast("int")
    orders = fact_orders.where(F.col("order_date_key") <= until)
    if "order_month" in fact_orders.columns:
        orders = orders.where(F.col("order_month") <= F.floor(until / 100))
    daily = orders.groupBy(F.col("order_date_key").alias("date_key")).agg(*sales_aggregates())
    days = dim_date.where(F.col("full_date") <= limit)
    return (
        days.join(daily, "date_key", "left")
        .withColumn("orders_count", F.coalesce("orders_count", F.lit(0)))
        .select(
            "full_date", "year", "month", "month_name", "week_of_year", "day_name", "is_weekend",
            "orders_count", "units_sold", *SALES_SUMS, *sales_averages(),
        )
        .orderBy(F.desc_nulls_first("full_date"))
    )


def kpi_revenue_totals(fact_orders: DataFrame) -> DataFrame:
    """One row of all-time totals and rates."""
    totals = fact_orders.agg(
        F.count("order_id").alias("total_orders"),
        F.sum("unit_count").alias("total_units_sold"),
        F.sum("gross_product_sales").alias("total_gross_product_sales"),
        F.sum("order_discount_amount").alias("total_discounts"),
        F.sum("refunded_amount").alias("total_refunds"),
        F.sum("net_sales").alias("total_net_sales"),
        F.count_if(F.col("order_discount_amount") > 0).alias("orders_with_discount"),
    )
    return totals.select(
        "total_orders",
        "total_units_sold",
        "total_gross_product_sales",
        "total_discounts",
        "total_refunds",
        "total_net_sales",
        C.ratio(F.col("total_refunds"), F.col("total_gross_product_sales"), 100).alias(
            "refund_rate_percent"
        ),
        C.ratio(F.col("total_net_sales"), F.col("total_orders")).alias("overall_aov"),
        "orders_with_discount",
        C.ratio(F.col("orders_with_discount"), F.col("total_orders"), 100).alias(
            "discount_usage_rate_percent"
        ),
    )


# ---- products -------------------------------------------------------------------------

def kpi_product_profitability(dim_products: DataFrame, fact_lines: DataFrame) -> DataFrame:
    """Volume, revenue, cost and margin per product, unsold products included.

    A product has one line name, so lines that are the first of their name in an order
    stand for the orders of the product. Facts without that mark are counted distinct.
    """
    quantity = F.col("quantity")
    if "first_of_name" in fact_lines.columns:
        orders = F.count_if("first_of_name")
    else:
        orders = F.count_distinct("order_key")
    sold = (
        fact_lines.where("product_key IS NOT NULL")
        .groupBy("product_key")
        .agg(
            orders.alias("orders_containing_product"),
            F.sum(quantity).alias("units_sold"),
            F.sum("gross_line_revenue").alias("gross_revenue"),
            F.sum("line_discount").alias("line_discounts"),
            F.sum("allocated_order_discount").alias("allocated_order_discounts"),
            F.sum("net_line_revenue").alias("net_revenue"),
            F.sum(F.col("estimated_cogs") * quantity).alias("total_estimated_cogs"),
            F.sum(F.col("gross_margin") * quantity).alias("total_gross_margin"),
            F.bool_or("has_missing_cost").alias("has_missing_cost"),
        )
    )
    return (
        dim_products.join(sold, "product_key", "left")
        .select(
            "internal_sku",
            "product_title",
            "size_ml",
            F.col("variant_price").alias("list_price"),
            "is_active",
            F.coalesce("orders_containing_product", F.lit(0)).alias("orders_containing_product"),
            "units_sold",
            "gross_revenue",
            "line_discounts",
            "allocated_order_discounts",
            "net_revenue",
            "total_estimated_cogs",
            "total_gross_margin",
            C.ratio(F.col("total_gross_margin"), F.col("net_revenue"), 100).alias("margin_percent"),
            C.ratio(F.col("net_revenue"), F.col("units_sold")).alias("avg_selling_price"),
            "has_missing_cost",
            F.when(F.col("has_missing_cost"), COGS_INCOMPLETE)
            .otherwise(COGS_COMPLETE)
            .alias("cogs_status"),
        )
        .orderBy(F.desc_nulls_last("net_revenue"))
    )


def kpi_cogs_detail(
    dim_products: DataFrame,
    fact_lines: DataFrame,
    costs: DataFrame,
    shares: int = SHARES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Use and cost of each material per product.

    Every line of a product has the same ingredients, so sums are recipe amounts times
    the number of lines; lines are never multiplied by ingredients. Amounts count once per
    line, whatever its quantity. ``counted`` may be the SKU map, to count its recipes.
    """
    lines = (
        fact_lines.where("product_key IS NOT NULL")
        .groupBy("product_key")
        .agg(F.count("*").alias("lines"))
    )
    known = costs.where("material_key IS NOT NULL")
    products = dim_products.select(
        "product_key", "internal_sku", "product_title", "recipe_id", "size_ml"
    )
    used = product_ingredients(products, known, shares, counted).join(lines, "product_key")

    def total(column: str) -> Column:
        return F.sum(F.col(column) * F.col("lines"))

    def average(column: str) -> Column:
        rows = F.sum(F.when(F.col(column).isNotNull(), F.col("lines")))
        return F.try_divide(total(column).cast("double"), rows.cast("double"))

    return (
        used.groupBy(
            "internal_sku",
            "product_title",
            "material_name",
            "material_category",
            F.col("material_has_known_cost").alias("has_known_cost"),
        )
        .agg(
            average("amount_ml").alias("avg_amount_ml_per_unit"),
            average("cost_per_ml").alias("cost_per_ml"),
            average("line_cost").alias("avg_cost_per_unit"),
            total("amount_ml").alias("total_ml_used"),
            total("line_cost").alias("total_cost"),
        )
        .orderBy("internal_sku", F.desc_nulls_last("total_cost"))
    )


# ---- customers ------------------------------------------------------------------------

def kpi_customer_segments(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.where("total_orders > 0")
        .groupBy("customer_segment")
        .agg(
            F.count("customer_key").alias("customer_count"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_spent").alias("total_revenue"),
            C.mean(F.col("total_spent")).alias("avg_customer_value"),
            C.mean(F.col("total_orders")).alias("avg_orders_per_customer"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"))
    )


def orders_of_customers(
    fact_orders: DataFrame, dim_customers: DataFrame, shares: int = SHARES
) -> DataFrame:
    """Orders of known customers with the date of the customer's first order."""
    orders = fact_orders.where("customer_key IS NOT NULL").select(
        "customer_key", "order_id", "order_date_key", "net_sales"
    )
    first = dim_customers.select("customer_key", "first_order_date")
    counts = dim_customers.select("customer_key", F.col("total_orders").alias("_rows"))
    return join_busy(orders, first, ["customer_key"], ["order_id"], counts=counts, shares=shares)


def kpi_new_vs_returning(
    fact_orders: DataFrame,
    dim_customers: DataFrame,
    dim_date: DataFrame,
    shares: int = SHARES,
) -> DataFrame:
    """Orders on the customer's first order date against all later ones.

    A calendar has a few thousand days; Spark sees its size and broadcasts it.
    """
    is_new = F.col("first_order_date") == F.col("full_date")
    days = dim_date.select(F.col("date_key").alias("order_date_key"), "full_date")
    orders = orders_of_customers(fact_orders, dim_customers, shares).join(
        days, "order_date_key"
    )
    return (
        orders.groupBy(F.when(is_new, "new").otherwise("returning").alias("customer_type"))
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("customer_key").alias("unique_customers"),
            F.sum("net_sales").alias("revenue"),
            C.mean(F.col("net_sales")).alias("avg_order_value"),
        )
    )


def kpi_repeat_purchase_rate(dim_customers: DataFrame) -> DataFrame:
    totals = dim_customers.where("total_orders > 0").agg(
        F.count("customer_key").alias("total_customers_with_orders"),
        F.count_if(F.col("total_orders") == 1).alias("one_time_customers"),
        F.count_if(F.col("total_orders") > 1).alias("repeat_customers"),
        C.mean(F.col("total_orders")).alias("avg_orders_per_customer"),
        C.mean(F.col("total_spent")).alias("avg_lifetime_value"),
    )
    return totals.withColumn(
        "repeat_purchase_rate_percent",
        C.ratio(F.col("repeat_customers"), F.col("total_customers_with_orders"), 100),
    )


# ---- shipping, marketing, search ------------------------------------------------------

def kpi_shipping_methods(fact_orders: DataFrame, dim_shipping: DataFrame) -> DataFrame:
    per_method = fact_orders.groupBy("shipping_method_key").agg(
        F.count("order_id").alias("order_count"),
        F.sum("net_sales").alias("revenue"),
        F.sum("shipping_amount").alias("shipping_collected"),
        C.mean(F.col("net_sales")).alias("avg_order_value"),
    )
    return (
        per_method.join(dim_shipping, "shipping_method_key")
        .select(
            "shipping_method_name", "is_local_delivery", "order_count", "revenue",
            "shipping_collected", "avg_order_value",
        )
        .orderBy(F.desc_nulls_first("order_count"))
    )


def kpi_marketing_performance(
    fact_marketing: DataFrame, attributed: DataFrame | None = None
) -> DataFrame:
    """Campaign figures and return on spend.

    The return needs revenue attributed to campaigns: ``attributed`` with columns
    ``campaign_name`` and ``revenue``, one row per campaign. Without it, it is NULL.
    """
    shown = [
        "campaign_name", "platform", "reach", "impressions", "amount_spent", "link_clicks",
        "landing_page_views", "cpm", "cpc", "ctr",
    ]
    if attributed is None:
        roas = F.lit(None).cast(C.RATE)
        return fact_marketing.select(*shown, roas.alias("estimated_roas"))
    spend = F.nullif(F.col("amount_spent"), F.lit(0).cast(C.MONEY))
    roas = F.try_divide(F.col("revenue").cast("double"), spend.cast("double"))
    return fact_marketing.join(
        attributed.select("campaign_name", "revenue"), "campaign_name", "left"
    ).select(*shown, roas.cast(C.RATE_SUM).alias("estimated_roas"))


def kpi_seo_performance(fact_search: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        fact_search.join(dim_date.select("date_key", "full_date", "week_of_year", "month"), "date_key")
        .select(
            "full_date", "week_of_year", "month", "clicks", "impressions", "ctr", "avg_position"
        )
        .orderBy(F.desc_nulls_first("full_date"))
    )


# ---- validation -----------------------------------------------------------------------

def subtotal_gap() -> Column:
    return F.abs(
        F.col("subtotal") - (F.col("gross_product_sales") - F.col("order_discount_amount"))
    )


def total_gap() -> Column:
    return F.abs(
        F.col("total_amount")
        - (F.col("subtotal") + F.col("shipping_amount") + F.col("tax_amount"))
    )


def within_tolerance(gap: Column) -> Column:
    return gap <= F.lit(TOLERANCE).cast(C.MONEY)


def validation_order_totals(fact_orders: DataFrame) -> DataFrame:
    """Do the stored subtotal and total of each order agree with their parts?"""
    def verdict(gap: str) -> Column:
        return F.when(within_tolerance(F.col(gap)), "PASS").otherwise("FAIL")

    return fact_orders.select(
        "order_id",
        "order_number",
        "gross_product_sales",
        "order_discount_amount",
        "subtotal",
        (F.col("gross_product_sales") - F.col("order_discount_amount")).alias("calculated_subtotal"),
        subtotal_gap().alias("subtotal_diff"),
        "total_amount",
        (F.col("subtotal") + F.col("shipping_amount") + F.col("tax_amount")).alias(
            "calculated_total"
        ),
        total_gap().alias("total_diff"),
    ).withColumns(
        {"subtotal_validation": verdict("subtotal_diff"), "total_validation": verdict("total_diff")}
    )
