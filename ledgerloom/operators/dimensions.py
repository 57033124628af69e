"""Dimension tables of the star schema."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.hotkeys import SHARES, join_busy
from ledgerloom.functions.numbering import first_per_key

# ---- fixed values ---------------------------------------------------------------------

CALENDAR_START = dt.date(2025, 1, 1)
CALENDAR_END = dt.date(2027, 12, 31)

# code, name, type, sells online
CHANNELS = [
    ("web", "Website", "web", True),
    ("pos", "Point of Sale", "pos", False),
    ("api", "API", "api", True),
    ("unknown", "Unknown", "other", True),
]

DEFAULT_VENDOR = "House brand"
DEFAULT_PRICE = Decimal("10.50")
UNKNOWN_METHOD = ("unknown", "Unknown", False)


# ---- calendar -------------------------------------------------------------------------

def calendar(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return _calendar_days(bounds)


def calendar_of(dates: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and last value of a date or timestamp column."""
    bounds = dates.agg(
        F.to_date(F.min(column)).alias("start"), F.to_date(F.max(column)).alias("end")
    )
    return _calendar_days(bounds.where("start IS NOT NULL"))


def _calendar_days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return days.select(
        C.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )


# ---- products and materials -----------------------------------------------------------

def dim_product(
    sku_map: DataFrame,
    products: DataFrame,
    default_vendor: str = DEFAULT_VENDOR,
    default_price: Decimal = DEFAULT_PRICE,
    shares: int = SHARES,
) -> DataFrame:
    """The SKU map, with vendor and price of the shop product where there is one."""
    shop = products.select(
        F.col("handle").alias("product_handle"), "vendor", "variant_price"
    )
    joined = join_busy(sku_map, shop, ["product_handle"], ["internal_sku"], "left", shares=shares)
    return joined.select(
        C.surrogate(F.col("internal_sku")).alias("product_key"),
        "internal_sku",
        "product_handle",
        F.col("lineitem_name").alias("product_title"),
        "size_ml",
        "recipe_id",
        "product_category",
        F.coalesce("vendor", F.lit(default_vendor)).alias("vendor"),
        F.coalesce("variant_price", F.lit(default_price)).cast(C.MONEY).alias("variant_price"),
        "is_active",
    )


def dim_material(material_costs: DataFrame) -> DataFrame:
    return material_costs.select(
        C.surrogate(F.col("material_id")).alias("material_key"),
        "material_id",
        "material_name",
        "ingredient_match",
        "category",
        "unit",
        "cost_per_unit",
        "cost_per_ml",
        "has_known_cost",
        "supplier",
    )


# ---- customers ------------------------------------------------------------------------

def customer_orders(orders: DataFrame) -> DataFrame:
    """First order, number of orders and net spend per e-mail, ignoring case.

    ``orders`` has one row per order, so counting rows counts orders. The sums are
    combined before the exchange, which makes a very busy e-mail harmless.
    """
    return (
        orders.where(C.filled(F.col("email")))
        .groupBy(C.email_key(F.col("email")).alias("email_key"))
        .agg(
            F.min("created_at").alias("first_order_at"),
            F.count("order_id").alias("total_orders"),
            F.sum(F.col("subtotal") - F.col("refunded_amount")).alias("total_spent"),
        )
    )


def customer_profiles(customers: DataFrame) -> DataFrame:
    """One profile per e-mail, ignoring case: the lowest customer id."""
    keyed = customers.where(C.filled(F.col("email"))).select(
        C.email_key(F.col("email")).alias("email_key"),
        "customer_id",
        "city",
        "province",
        "province_code",
        "country",
        "country_code",
        "accepts_email_marketing",
        "accepts_sms_marketing",
    )
    ties = [c for c in keyed.columns if c not in ("email_key", "customer_id")]
    return first_per_key(keyed, ["email_key"], ["customer_id", *ties])


def segment(total_orders: Column) -> Column:
    return (
        F.when(total_orders == 0, "prospect")
        .when(total_orders == 1, "new")
        .when(total_orders >= 2, "returning")
        .otherwise("unknown")
    )


def dim_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers seen in orders; the e-mail appears only as a hash."""
    joined = customer_orders(orders).join(customer_profiles(customers), "email_key", "left")
    hashed = C.email_hash(F.col("email_key"))
    return joined.select(
        customer_key(hashed).alias("customer_key"),
        hashed.alias("customer_id_hash"),
        "customer_id",
        "city",
        "province",
        "province_code",
        "country",
        "country_code",
        F.coalesce("accepts_email_marketing", F.lit(False)).alias("accepts_email_marketing"),
        F.coalesce("accepts_sms_marketing", F.lit(False)).alias("accepts_sms_marketing"),
        F.to_date("first_order_at").alias("first_order_date"),
        "total_orders",
        F.coalesce("total_spent", F.lit(0)).cast(C.MONEY_SUM).alias("total_spent"),
        segment(F.col("total_orders")).alias("customer_segment"),
    )


def customer_key(hashed: Column) -> Column:
    return C.surrogate(hashed)


# ---- channels and shipping ------------------------------------------------------------

def dim_channel(spark: SparkSession) -> DataFrame:
    names = ("channel_code", "channel_name", "channel_type", "is_online")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in CHANNELS]
    seeds = spark.range(1).select(F.inline(F.array(*rows)))
    return seeds.select(C.surrogate(F.col("channel_code")).alias("channel_key"), *names)


def dim_shipping_method(orders: DataFrame) -> DataFrame:
    """One row per method code; a single unknown row if no order names a method."""
    named = orders.where(C.filled(F.col("shipping_method")))
    methods = named.groupBy(
        C.method_code(F.col("shipping_method")).alias("shipping_method_code")
    ).agg(F.min("shipping_method").alias("shipping_method_name"))
    methods = methods.select(
        "shipping_method_code",
        "shipping_method_name",
        F.lower("shipping_method_name").contains("local").alias("is_local_delivery"),
    )
    code, name, local = UNKNOWN_METHOD
    unknown = methods.agg(F.count("*").alias("n")).where("n = 0").select(
        F.lit(code).alias("shipping_method_code"),
        F.lit(name).alias("shipping_method_name"),
        F.lit(local).alias("is_local_delivery"),
    )
    both = methods.unionByName(unknown)
    return both.select(
        C.surrogate(F.col("shipping_method_code")).alias("shipping_method_key"), *both.columns
    )
