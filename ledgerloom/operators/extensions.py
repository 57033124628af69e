"""KPIs that are promised next to the marts: rollups, trends, cohorts and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import marts


def sales_by_period(dim_date: DataFrame, fact_orders: DataFrame, unit: str) -> DataFrame:
    """Sales per ``week`` (starting Monday) or ``month`` of the calendar, empty ones kept."""
    daily = fact_orders.groupBy(F.col("order_date_key").alias("date_key")).agg(
        *marts.sales_aggregates()
    )
    period = F.to_date(F.date_trunc(unit, "full_date")).alias("period_start")
    totals = (
        dim_date.select("date_key", "full_date")
        .join(daily, "date_key", "left")
        .groupBy(period)
        .agg(
            F.coalesce(F.sum("orders_count"), F.lit(0)).alias("orders_count"),
            *[F.sum(c).alias(c) for c in ("units_sold", *marts.SALES_SUMS)],
        )
    )
    return totals.select("*", *marts.sales_averages()).orderBy(F.desc("period_start"))


def week_over_week(weekly: DataFrame) -> DataFrame:
    """Net sales and order value of each week next to the week before.

    The input has one row per calendar week, so a single ordered window is small.
    """
    before = Window.orderBy("period_start")
    return weekly.select(
        "period_start",
        "orders_count",
        "net_sales",
        "aov",
        F.lag("net_sales").over(before).alias("previous_net_sales"),
        F.lag("aov").over(before).alias("previous_aov"),
    ).select(
        "*",
        (F.col("net_sales") - F.col("previous_net_sales")).alias("net_sales_change"),
        C.ratio(
            F.col("net_sales") - F.col("previous_net_sales"), F.col("previous_net_sales"), 100
        ).alias("net_sales_change_percent"),
        (F.col("aov") - F.col("previous_aov")).alias("aov_change"),
    )


def customer_cohorts(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Customers, orders and revenue by month of first order and months since then."""
    orders = marts.orders_of_customers(fact_orders, dim_customers)
    order_month = F.floor(F.col("order_date_key") / 100)
    months = (
        (F.floor(order_month / 100) - F.year("first_order_date")) * 12
        + order_month % 100
        - F.month("first_order_date")
    ).cast("int")
    return orders.groupBy(
        F.trunc("first_order_date", "month").alias("cohort_month"), months.alias("months_since")
    ).agg(
        F.count_distinct("customer_key").alias("customers"),
        F.count("*").alias("orders"),
        F.sum("net_sales").alias("revenue"),
    )


def ad_ratios(fact_marketing: DataFrame) -> DataFrame:
    """Cost per thousand impressions, cost per click and click rate, where not exported."""
    spend = F.col("amount_spent")
    return fact_marketing.select(
        "campaign_name",
        "impressions",
        "link_clicks",
        "amount_spent",
        F.coalesce(F.col("cpm").cast("double"), C.ratio(spend, F.col("impressions"), 1000)).alias("cpm"),
        F.coalesce(F.col("cpc").cast("double"), C.ratio(spend, F.col("link_clicks"))).alias("cpc"),
        F.coalesce(
            F.col("ctr").cast("double"), C.ratio(F.col("link_clicks"), F.col("impressions"), 100)
        ).alias("ctr"),
    )


def search_ctr(fact_search: DataFrame) -> DataFrame:
    """Click-through rate computed from clicks and impressions, next to the exported one."""
    return fact_search.select(
        "date_key",
        "clicks",
        "impressions",
        "ctr",
        C.ratio(F.col("clicks"), F.col("impressions")).alias("computed_ctr"),
    )
