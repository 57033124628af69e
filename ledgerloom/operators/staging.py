"""Text tables to typed tables. Every function maps a raw DataFrame to a staging one.

``cast`` decides what a malformed value does: ``columns.typed`` stops the job,
``columns.typed_lenient`` gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.hotkeys import SHARES
from ledgerloom.functions.numbering import first_per_key, number_rows

PASS_THROUGH = [
    "email", "financial_status", "fulfillment_status", "currency", "shipping_method",
    "risk_level", "source", "payment_method", "billing_city", "billing_province",
    "billing_country", "billing_zip", "shipping_city", "shipping_province",
    "shipping_country", "shipping_zip",
]
ORDER_MONEY = ["subtotal", "shipping", "taxes", "total"]
ORDER_TIMES = ["created_at", "paid_at", "fulfilled_at", "cancelled_at"]


def _or(c: Column, value: int) -> Column:
    return F.coalesce(c, F.lit(value).cast(C.MONEY))


def _first_present(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that the export has; blank text if it has none."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit("")


def stg_orders(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    """One row per order id.

    An order export repeats the order on every line, with the order columns filled on the
    first line only. The earliest ``created_at`` wins, then the row that has a subtotal.
    """
    used = [
        "id", "name", "discount_code", "discount_amount", "refunded_amount",
        *PASS_THROUGH, *ORDER_MONEY, *ORDER_TIMES,
    ]
    # Lines of an order that repeat the same order columns are one row here before any is sorted.
    rows = raw.select(*used).where(C.filled(F.col("id"))).distinct()
    ties = [c for c in used if c not in ("id", "created_at")]
    rows = first_per_key(
        rows,
        ["id"],
        [F.asc_nulls_last("created_at"), ~C.filled(F.col("subtotal")), *ties],
    )
    return rows.select(
        cast(F.col("id"), "bigint").alias("order_id"),
        F.col("name").alias("order_number"),
        *PASS_THROUGH,
        *[cast(F.col(c), C.MONEY).alias(c) for c in ORDER_MONEY],
        C.blank_to_null(F.col("discount_code")).alias("discount_code"),
        *[
            _or(cast(F.col(c), C.MONEY), 0).alias(c)
            for c in ("discount_amount", "refunded_amount")
        ],
        *[cast(F.col(c), "timestamp").alias(c) for c in ORDER_TIMES],
    )


def stg_order_lines(
    raw: DataFrame, cast: C.Caster = C.typed, shares: int = SHARES
) -> DataFrame:
    """One row per order line, numbered inside its order by line name."""
    rows = raw.where(C.filled(F.col("id")) & C.filled(F.col("lineitem_name"))).select(
        cast(F.col("id"), "bigint").alias("order_id"),
        F.col("name").alias("order_number"),
        "lineitem_name",
        C.blank_to_null(F.col("lineitem_sku")).alias("lineitem_sku"),
        F.coalesce(cast(F.col("lineitem_quantity"), "int"), F.lit(1)).alias("lineitem_quantity"),
        cast(F.col("lineitem_price"), C.MONEY).alias("lineitem_price"),
        cast(F.col("lineitem_compare_at_price"), C.MONEY).alias("lineitem_compare_at_price"),
        _or(cast(F.col("lineitem_discount"), C.MONEY), 0).alias("lineitem_discount"),
        "lineitem_fulfillment_status",
        "vendor",
        cast(F.col("created_at"), "timestamp").alias("created_at"),
    )
    return number_lines(rows, shares)


def number_lines(rows: DataFrame, shares: int = SHARES) -> DataFrame:
    """Add ``line_number`` and the line's key to order lines without them.

    ``first_of_name`` is true on one line per order and line name; with it, counting the
    orders of a product needs no distinct count over all lines.
    """
    numbered = number_rows(
        rows,
        ["order_id"],
        [["lineitem_name"], ["lineitem_price", "lineitem_quantity", "lineitem_discount"]],
        "line_number",
        shares,
        first="first_of_name",
    )
    return numbered.withColumn("order_line_id", order_line_key())


def order_line_key() -> Column:
    """Key of an order line: exact, so it cannot collide."""
    return F.concat_ws("-", "order_id", "line_number")


def stg_products(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    """One row per handle: the first by title."""
    used = [
        "handle", "title", "vendor", "product_category", "type", "tags", "variant_sku",
        "variant_price", "variant_compare_at_price", "variant_inventory_qty", "published",
        "status",
    ]
    rows = raw.select(*used).where(C.filled(F.col("handle")))
    ties = [c for c in used if c not in ("handle", "title")]
    rows = first_per_key(rows, ["handle"], [F.asc_nulls_last("title"), *ties])
    return rows.select(
        C.surrogate(F.col("handle")).alias("product_id"),
        "handle",
        "title",
        "vendor",
        "product_category",
        F.col("type").alias("product_type"),
        "tags",
        C.blank_to_null(F.col("variant_sku")).alias("variant_sku"),
        cast(F.col("variant_price"), C.MONEY).alias("variant_price"),
        cast(F.col("variant_compare_at_price"), C.MONEY).alias("variant_compare_at_price"),
        F.coalesce(cast(F.col("variant_inventory_qty"), "int"), F.lit(0)).alias(
            "variant_inventory_qty"
        ),
        C.flag(F.col("published"), "true", "false").alias("is_published"),
        "status",
    )


def stg_customers(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    """Customer profiles, from either of the two header dialects of the export.

    The full export has ``customer_id`` and ``default_address_*`` codes only, so names
    are filled from codes; the short one has ``id`` and both names and codes.
    """
    key = _first_present(raw, "customer_id", "id")
    province_code = _first_present(raw, "default_address_province_code", "province_code")
    country_code = _first_present(raw, "default_address_country_code", "country_code")
    return raw.where(C.filled(key)).select(
        cast(key, "bigint").alias("customer_id"),
        "first_name",
        "last_name",
        "email",
        C.flag(F.col("accepts_email_marketing"), "yes", "no").alias("accepts_email_marketing"),
        C.flag(F.col("accepts_sms_marketing"), "yes", "no").alias("accepts_sms_marketing"),
        _first_present(raw, "default_address_city", "city").alias("city"),
        _first_present(raw, "province", "default_address_province_code").alias("province"),
        province_code.alias("province_code"),
        _first_present(raw, "country", "default_address_country_code").alias("country"),
        country_code.alias("country_code"),
        _first_present(raw, "default_address_zip", "zip").alias("zip"),
        _or(cast(F.col("total_spent"), C.MONEY), 0).alias("total_spent"),
        F.coalesce(cast(F.col("total_orders"), "int"), F.lit(0)).alias("total_orders"),
    )


def stg_product_sku_map(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    return raw.where(C.filled(F.col("internal_sku"))).select(
        "internal_sku",
        "lineitem_name",
        "product_handle",
        cast(F.col("size_ml"), "int").alias("size_ml"),
        "recipe_id",
        "product_category",
        C.flag(F.col("is_active"), "true", "true").alias("is_active"),
    )


def stg_material_costs(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    return raw.where(C.filled(F.col("material_id"))).select(
        "material_id",
        "material_name",
        "ingredient_match",
        "category",
        "unit",
        cast(F.col("cost_per_unit"), C.RATE).alias("cost_per_unit"),
        cast(F.col("cost_per_ml"), C.RATE).alias("cost_per_ml"),
        C.flag(F.col("has_known_cost"), "true", "false").alias("has_known_cost"),
        "supplier",
    )


def recipe_ingredients(raw: DataFrame, cast: C.Caster = C.typed) -> DataFrame:
    """One row per recipe ingredient, not numbered: all that costing needs."""
    return raw.where(C.filled(F.col("recipe_id"))).select(
        "recipe_id",
        "recipe_name",
        "variant",
        cast(F.col("batch_size_ml"), "int").alias("batch_size_ml"),
        "ingredient_match",
        cast(F.col("percent"), C.RATE).alias("percent"),
        cast(F.col("amount_ml"), C.RATE).alias("amount_ml"),
        "material_id",
    )


def stg_recipes(
    raw: DataFrame, cast: C.Caster = C.typed, shares: int = SHARES
) -> DataFrame:
    """One row per recipe ingredient, numbered inside the recipe."""
    return number_rows(
        recipe_ingredients(raw, cast),
        ["recipe_id"],
        [["batch_size_ml", "variant"], ["ingredient_match", "material_id"]],
        "recipe_line",
        shares,
    )


def stg_meta_ads(
    raw: DataFrame, cast: C.Caster = C.typed, shares: int = SHARES
) -> DataFrame:
    """Advertising campaigns; spend comes from whichever spend column is there."""
    def number(name: str, type_name: str) -> Column:
        return cast(_first_present(raw, name), type_name).alias(name)

    spend = [
        cast(C.bare_amount(F.col(c)), C.MONEY)
        for c in ("amount_spent", "amount_spent_usd")
        if c in raw.columns
    ]
    rows = raw.where(C.filled(F.col("campaign_name"))).select(
        "campaign_name",
        number("reach", "bigint"),
        number("frequency", C.RATE),
        number("impressions", "bigint"),
        number("cpm", C.RATE),
        F.coalesce(*spend, F.lit(0).cast(C.MONEY)).alias("amount_spent"),
        number("link_clicks", "bigint"),
        number("cpc", C.RATE),
        number("ctr", C.RATE),
        number("landing_page_views", "bigint"),
    )
    return _with_occurrence_key(rows, "campaign_name", "campaign_id", shares)


def stg_gsc_daily(
    raw: DataFrame, cast: C.Caster = C.typed, shares: int = SHARES
) -> DataFrame:
    """Daily search figures; the click-through rate is stored as a fraction."""
    percent = cast(F.replace(F.col("ctr"), F.lit("%"), F.lit("")), "decimal(12,6)")
    day = F.to_date("date", "yyyy-MM-dd")
    if cast is C.typed_lenient:
        day = F.try_to_date("date", "yyyy-MM-dd")
    rows = raw.where(C.filled(F.col("date"))).select(
        day.alias("date"),
        cast(F.col("clicks"), "bigint").alias("clicks"),
        cast(F.col("impressions"), "bigint").alias("impressions"),
        (percent / 100).cast(C.RATE).alias("ctr"),
        cast(F.col("position"), C.MONEY).alias("position"),
    )
    return _with_occurrence_key(rows, "date", "gsc_daily_id", shares)


def _with_occurrence_key(df: DataFrame, column: str, key: str, shares: int) -> DataFrame:
    """Key for tables whose natural key may repeat: the value and its occurrence."""
    rest = [c for c in df.columns if c != column]
    numbered = number_rows(df, [column], [rest], "_occurrence", shares)
    return numbered.withColumn(
        key, C.surrogate(F.concat_ws("#", F.col(column).cast("string"), "_occurrence"))
    ).drop("_occurrence")
