"""Fact tables of the star schema.

Keys of dimensions are computed from natural keys instead of looked up: channels,
customers and shipping methods are derived from the same orders, so each computed key has
its row. ``quality.broken_references`` proves it on the written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.hotkeys import SHARES, join_busy, rows_per_key
from ledgerloom.functions.numbering import first_per_key
from ledgerloom.operators import dimensions as D
from ledgerloom.operators.staging import order_line_key

# ---- fixed values ---------------------------------------------------------------------

DEFAULT_CHANNEL = "web"
COSTED_VARIANT = "final"
ADS_PLATFORM = "meta"


# ---- orders ---------------------------------------------------------------------------

def order_line_summary(lines: DataFrame) -> DataFrame:
    """Units, lines and gross revenue per order."""
    return lines.groupBy("order_id").agg(
        F.sum("lineitem_quantity").alias("unit_count"),
        F.count("*").alias("line_item_count"),
        F.sum(F.col("lineitem_price") * F.col("lineitem_quantity"))
        .cast(C.MONEY_SUM)
        .alias("calculated_gross"),
    )


def channel_key(source: Column, default_code: str = DEFAULT_CHANNEL) -> Column:
    """Key of the named channel, or of the default one if the name is not a channel."""
    code = F.lower(source)
    known = code.isin([c[0] for c in D.CHANNELS])
    return C.surrogate(F.when(known, code).otherwise(F.lit(default_code)))


def fact_order(
    orders: DataFrame,
    lines: DataFrame,
    shipping_methods: DataFrame,
    default_channel: str = DEFAULT_CHANNEL,
) -> DataFrame:
    """One row per order with its amounts, counts and dimension keys.

    Orders that name no shipping method get the method with the smallest code.
    """
    default_method = shipping_methods.agg(F.min("shipping_method_code")).scalar()
    method = F.col("shipping_method")
    method_code = F.when(C.filled(method), C.method_code(method)).otherwise(default_method)
    customer = F.when(
        C.filled(F.col("email")), D.customer_key(C.email_hash(F.col("email")))
    )
    joined = orders.join(order_line_summary(lines), "order_id", "left")
    gross = F.coalesce("calculated_gross", F.col("subtotal") + F.col("discount_amount"))
    return joined.select(
        F.col("order_id").alias("order_key"),
        "order_id",
        "order_number",
        C.date_key(F.col("created_at")).alias("order_date_key"),
        customer.alias("customer_key"),
        channel_key(F.col("source"), default_channel).alias("channel_key"),
        C.surrogate(method_code).alias("shipping_method_key"),
        gross.cast(C.MONEY_SUM).alias("gross_product_sales"),
        F.col("discount_amount").alias("order_discount_amount"),
        "subtotal",
        F.col("shipping").alias("shipping_amount"),
        F.col("taxes").alias("tax_amount"),
        F.col("total").alias("total_amount"),
        "refunded_amount",
        (F.col("subtotal") - F.col("refunded_amount")).cast(C.MONEY).alias("net_sales"),
        F.coalesce("line_item_count", F.lit(1)).cast("bigint").alias("line_item_count"),
        F.coalesce("unit_count", F.lit(1)).cast("bigint").alias("unit_count"),
        "financial_status",
        "fulfillment_status",
        "risk_level",
        "created_at",
        "paid_at",
        "fulfilled_at",
    )


# ---- cost of goods --------------------------------------------------------------------

def recipe_costs(
    recipes: DataFrame,
    materials: DataFrame,
    shares: int = SHARES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Cost of each ingredient of one unit, for the recipe variant that is sold.

    An ingredient priced by volume costs amount times price (NULL without an amount),
    packaging costs its piece price, and an unknown cost counts as 0. ``recipe_line`` is
    carried along if the recipes are numbered; ``counted`` may be the same ones before that.
    """
    material = materials.select(
        "material_id", "material_name", "category", "cost_per_ml", "cost_per_unit",
        F.col("has_known_cost").alias("_known"),
    )
    known = F.coalesce("_known", F.lit(False))
    cost = (
        F.when(known & F.col("cost_per_ml").isNotNull(), F.col("amount_ml") * F.col("cost_per_ml"))
        .when(known & F.col("cost_per_unit").isNotNull(), F.col("cost_per_unit"))
        .otherwise(F.lit(0))
    )
    sold = recipes.where(F.col("variant") == COSTED_VARIANT)
    return (
        join_busy(
            sold,
            material.withColumn("_found", F.lit(True)),
            ["material_id"],
            recipes.columns,
            "left",
            rows_per_key(sold if counted is None else counted, ["material_id"]),
            shares,
        )
        .select(
            "recipe_id",
            F.col("batch_size_ml").alias("size_ml"),
            *[c for c in recipes.columns if c == "recipe_line"],
            F.when(F.col("_found"), C.surrogate(F.col("material_id"))).alias("material_key"),
            "material_name",
            F.col("category").alias("material_category"),
            F.col("ingredient_match").alias("ingredient_name"),
            "amount_ml",
            F.coalesce("cost_per_ml", "cost_per_unit").alias("cost_per_ml"),
            cost.cast(C.RATE).alias("line_cost"),
            known.alias("has_known_cost"),
            F.col("_known").alias("material_has_known_cost"),
        )
    )


def unit_costs(costs: DataFrame) -> DataFrame:
    """Cost of one unit per recipe and size, and whether a part of it is unknown."""
    return costs.groupBy("recipe_id", "size_ml").agg(
        F.coalesce(F.sum("line_cost"), F.lit(0)).cast(C.RATE_SUM).alias("unit_cogs"),
        F.bool_or(~F.col("has_known_cost")).alias("unit_missing_cost"),
    )


def sku_by_line_name(sku_map: DataFrame) -> DataFrame:
    """One SKU per line name, so that a lookup cannot multiply lines: active ones first."""
    named = sku_map.where(C.filled(F.col("lineitem_name"))).select(
        "lineitem_name", "internal_sku", "recipe_id", "size_ml", "is_active"
    )
    return first_per_key(
        named, ["lineitem_name"], [F.desc_nulls_last("is_active"), "internal_sku", "recipe_id", "size_ml"]
    )


def product_costs(
    sku_map: DataFrame, costs: DataFrame, shares: int = SHARES
) -> DataFrame:
    """Per line name: the product it stands for and the cost of one unit."""
    recipe = ["recipe_id", "size_ml"]
    skus = sku_by_line_name(sku_map)
    joined = join_busy(
        skus, unit_costs(costs), recipe, ["lineitem_name"], "left", shares=shares, counted=sku_map
    )
    return joined.select(
        "lineitem_name",
        C.surrogate(F.col("internal_sku")).alias("product_key"),
        "unit_cogs",
        "unit_missing_cost",
    )


# ---- order lines ----------------------------------------------------------------------

def allocated_cents(line: Column, order_gross: Column, discount: Column) -> Column:
    """A line's share of the order discount, in whole cents, half away from zero.

    All arguments are bigint cents.
    """
    share = C.multiply_divide(line, discount, order_gross)
    return F.when(order_gross > 0, share).otherwise(F.lit(0).cast("bigint"))


def _line_cents(
    lines: DataFrame, fact_orders: DataFrame, shares: int, counted: DataFrame | None
) -> DataFrame:
    """Order lines with their amounts and their share of the order discount, in cents."""
    orders = fact_orders.select(
        "order_id",
        "order_key",
        "order_date_key",
        C.scaled(F.col("gross_product_sales"), 2).alias("order_cents"),
        C.scaled(F.col("order_discount_amount"), 2).alias("discount_cents"),
    )
    joined = join_busy(lines, orders, ["order_id"], ["line_number"], shares=shares, counted=counted)
    amounts = joined.select(
        "order_key",
        "order_id",
        "line_number",
        "order_date_key",
        "lineitem_name",
        *[c for c in lines.columns if c == "first_of_name"],
        F.col("lineitem_quantity").alias("quantity"),
        F.col("lineitem_price").alias("unit_price"),
        F.col("lineitem_discount").alias("line_discount"),
        (C.scaled(F.col("lineitem_price"), 2) * F.col("lineitem_quantity")).alias("gross_cents"),
        "order_cents",
        "discount_cents",
    )
    share = allocated_cents(F.col("gross_cents"), F.col("order_cents"), F.col("discount_cents"))
    return amounts.withColumn("share_cents", share)


def _line_amounts() -> list[Column]:
    return [
        "order_key",
        "order_id",
        "line_number",
        "order_date_key",
        "quantity",
        "unit_price",
        C.unscaled(F.col("gross_cents"), 2, C.MONEY_SUM).alias("gross_line_revenue"),
        "line_discount",
        C.unscaled(F.col("share_cents"), 2, C.MONEY_SUM).alias("allocated_order_discount"),
    ]


def allocate_discounts(
    lines: DataFrame,
    fact_orders: DataFrame,
    shares: int = SHARES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Order lines with their share of the order discount, in proportion to gross revenue.

    ``counted`` may be the same lines before they were numbered: rows per key are counted there.
    """
    return _line_cents(lines, fact_orders, shares, counted).select("lineitem_name", *_line_amounts())


def fact_order_line(
    lines: DataFrame,
    fact_orders: DataFrame,
    products: DataFrame,
    shares: int = SHARES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per order line with revenue, estimated cost and margin per unit.

    ``products`` is ``product_costs``: cost depends on the product only, so it is summed
    per product before it meets the lines. A line without a costed recipe costs 0, is
    flagged, and has a margin of 100 percent. ``counted`` is as in ``allocate_discounts``.
    """
    priced = join_busy(
        _line_cents(lines, fact_orders, shares, counted),
        products,
        ["lineitem_name"],
        ["order_id", "line_number"],
        "left",
        shares=shares,
        counted=lines if counted is None else counted,
    )
    # Margins are worked out in whole units of 1/10000. Each step is a projection of its
    # own, so that no step is computed twice.
    net_cents = (
        F.col("gross_cents") - C.scaled(F.col("line_discount"), 2) - F.col("share_cents")
    )
    priced = priced.withColumns(
        {
            "net_cents": net_cents,
            "estimated_cogs": F.coalesce("unit_cogs", F.lit(0).cast(C.RATE_SUM)),
        }
    )
    net, quantity = F.col("net_units"), F.col("quantity").cast("bigint")
    priced = priced.withColumn("net_units", F.col("net_cents") * 100).withColumn(
        "profit_units", net - C.scaled(F.col("estimated_cogs"), 4) * quantity
    )
    profit = F.col("profit_units")
    percent = C.multiply_divide(profit, F.lit(1_000_000).cast("bigint"), net)
    percent = F.when(net > 0, F.when(quantity != 0, percent)).otherwise(F.lit(0).cast("bigint"))
    priced = priced.withColumns(
        {
            "margin_units": C.divide_half_away(profit, quantity),
            "percent_units": F.when(F.col("unit_missing_cost").isNotNull(), percent).otherwise(
                F.lit(1_000_000).cast("bigint")
            ),
        }
    )
    return priced.select(
        order_line_key().alias("order_line_key"),
        "product_key",
        *_line_amounts(),
        C.unscaled(F.col("net_cents"), 2, C.MONEY_SUM).alias("net_line_revenue"),
        "estimated_cogs",
        F.coalesce("unit_missing_cost", F.lit(True)).alias("has_missing_cost"),
        C.unscaled(F.col("margin_units"), 4, C.RATE_SUM).alias("gross_margin"),
        C.unscaled(F.col("percent_units"), 4, C.RATE_SUM).alias("margin_percent"),
        *[c for c in lines.columns if c == "first_of_name"],
    )


def product_ingredients(
    products: DataFrame, costs: DataFrame, shares: int = SHARES, counted: DataFrame | None = None
) -> DataFrame:
    """Costed ingredients of one unit of each product, next to the product's columns.

    ``counted`` may be the SKU map: it has the recipes of the products, and is less work.
    """
    recipe = ["recipe_id", "size_ml"]
    return join_busy(products, costs, recipe, ["product_key"], shares=shares, counted=counted)


def lines_per_product(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Rows per product, counted by line name before names meet products."""
    named = rows_per_key(lines, ["lineitem_name"]).join(products, "lineitem_name")
    return named.where("product_key IS NOT NULL").groupBy("product_key").agg(F.sum("_rows").alias("_rows"))


def fact_cogs_estimate(
    fact_lines: DataFrame,
    dim_products: DataFrame,
    costs: DataFrame,
    shares: int = SHARES,
    counts: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per order line and recipe ingredient; ``costs`` of numbered recipes.

    ``counts`` may be ``lines_per_product``; without it lines are counted by product.
    ``counted`` is as in ``product_ingredients``.
    """
    lines = fact_lines.where("product_key IS NOT NULL").select("order_line_key", "product_key")
    products = dim_products.select("product_key", "recipe_id", "size_ml")
    ingredients = product_ingredients(products, costs, shares, counted)
    joined = join_busy(lines, ingredients, ["product_key"], ["order_line_key"], "inner", counts, shares)
    return joined.select(
        F.concat_ws("-", "order_line_key", "recipe_line").alias("cogs_key"),
        "order_line_key",
        "product_key",
        "material_key",
        "ingredient_name",
        "amount_ml",
        "cost_per_ml",
        "line_cost",
        "has_known_cost",
    )


# ---- marketing and search -------------------------------------------------------------

def fact_marketing_spend(ads: DataFrame, platform: str = ADS_PLATFORM) -> DataFrame:
    return ads.where(F.col("campaign_name").isNotNull()).select(
        F.col("campaign_id").alias("marketing_key"),
        "campaign_name",
        F.lit(platform).alias("platform"),
        "reach",
        "impressions",
        "amount_spent",
        "link_clicks",
        "landing_page_views",
        "cpm",
        "cpc",
        "ctr",
    )


def fact_gsc_daily(search: DataFrame) -> DataFrame:
    return search.where(F.col("date").isNotNull()).select(
        F.col("gsc_daily_id").alias("gsc_daily_key"),
        C.date_key(F.col("date")).alias("date_key"),
        "clicks",
        "impressions",
        "ctr",
        F.col("position").alias("avg_position"),
    )
