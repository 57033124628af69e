"""One query per operator, over star-schema tables, with portable column types.

``COLUMNS`` lists the result columns by type, so that results can be compared with
another engine: i bigint, d double, s text, b boolean, D date, t timestamp as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import columns as C
from ledgerloom.operators import dimensions as D
from ledgerloom.operators import exports, extensions, facts, marts, quality, staging
from ledgerloom.plans.warehouse import load_summary
from ledgerloom.session import configure
from ledgerloom.sources.csv import clean_headers, normalise
from ledgerloom.sources.star_tables import Shop

AS_OF = dt.date(2000, 12, 31)

SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string", "b": "boolean", "D": "date", "t": "string"}

_ORDER_TEXT = (
    "s order_number email financial_status fulfillment_status currency shipping_method risk_level "
    "source payment_method billing_city billing_province billing_country billing_zip shipping_city "
    "shipping_province shipping_country shipping_zip discount_code"
)
_EXPORT = (
    "s id name email source shipping_method financial_status fulfillment_status currency "
    "risk_level payment_method billing_city billing_province billing_country billing_zip "
    "shipping_city shipping_province shipping_country shipping_zip subtotal shipping taxes total "
    "discount_code discount_amount refunded_amount created_at paid_at fulfilled_at cancelled_at "
    "lineitem_name lineitem_sku lineitem_quantity lineitem_price lineitem_compare_at_price "
    "lineitem_discount lineitem_fulfillment_status vendor"
)
_ORDER_FACT = (
    "i order_key order_id order_date_key line_item_count unit_count; "
    "s order_number customer_key channel_key shipping_method_key financial_status "
    "fulfillment_status risk_level; t created_at paid_at fulfilled_at; "
    "d gross_product_sales order_discount_amount subtotal shipping_amount tax_amount "
    "total_amount refunded_amount net_sales"
)
_LINE_FACT = (
    "s order_line_key product_key; i order_key order_id line_number order_date_key quantity; "
    "d unit_price gross_line_revenue line_discount allocated_order_discount net_line_revenue "
    "estimated_cogs gross_margin margin_percent; b has_missing_cost"
)
_DATE = (
    "i date_key year quarter month week_of_year day_of_month day_of_week fiscal_year "
    "fiscal_quarter; D full_date; s month_name day_name; b is_weekend is_holiday"
)
_PRODUCT = (
    "s product_key internal_sku product_handle product_title recipe_id product_category vendor; "
    "i size_ml; d variant_price; b is_active"
)
_CUSTOMER = (
    "s customer_key customer_id_hash city province province_code country country_code "
    "customer_segment; b accepts_email_marketing accepts_sms_marketing; D first_order_date; "
    "i total_orders; d total_spent"
)
_CHANNEL = "s channel_key channel_code channel_name channel_type; b is_online; i orders"
_METHOD = "s shipping_method_key shipping_method_code shipping_method_name; b is_local_delivery"
_MATERIAL = (
    "s material_key material_id material_name ingredient_match category unit supplier; "
    "d cost_per_unit cost_per_ml; b has_known_cost"
)
_MARKETING = (
    "s marketing_key campaign_name platform; i reach impressions link_clicks landing_page_views; "
    "d amount_spent cpm cpc ctr"
)
_SEARCH = "s gsc_daily_key; i date_key clicks impressions; d ctr avg_position"
_TOTALS = (
    "i total_orders total_units_sold orders_with_discount; d total_gross_product_sales "
    "total_discounts total_refunds total_net_sales refund_rate_percent overall_aov "
    "discount_usage_rate_percent"
)
_SALES = (
    "i orders_count units_sold; d gross_product_sales discounts_total refunds_total net_sales "
    "shipping_collected taxes_collected total_collected aov avg_units_per_order"
)
_CHECKS = "s table_name check_name; i violations"

COLUMNS = {
    "header_normalise": _EXPORT,
    "apostrophe_strip": _EXPORT,
    "stg_orders_dedupe": "i order_id; " + _ORDER_TEXT + "; d subtotal shipping taxes total "
    "discount_amount refunded_amount; t created_at paid_at fulfilled_at cancelled_at",
    "stg_order_lines": "i order_id line_number lineitem_quantity; s order_line_id order_number "
    "lineitem_name lineitem_sku lineitem_fulfillment_status vendor; d lineitem_price "
    "lineitem_compare_at_price lineitem_discount; t created_at",
    "stg_products": "s product_id handle title vendor product_category product_type tags "
    "variant_sku status; d variant_price variant_compare_at_price; i variant_inventory_qty; "
    "b is_published",
    "stg_customers": "i customer_id total_orders; s first_name last_name email city province "
    "province_code country country_code zip; b accepts_email_marketing accepts_sms_marketing; "
    "d total_spent",
    "stg_sku_map": "s internal_sku lineitem_name product_handle recipe_id product_category; "
    "i size_ml; b is_active",
    "stg_material_costs": "s material_id material_name ingredient_match category unit supplier; "
    "d cost_per_unit cost_per_ml; b has_known_cost",
    "stg_recipes": "s recipe_id recipe_name variant ingredient_match material_id; "
    "i batch_size_ml recipe_line; d percent amount_ml",
    "stg_meta_ads": "s campaign_id campaign_name; i reach impressions link_clicks "
    "landing_page_views; d amount_spent frequency cpm cpc ctr",
    "stg_gsc_daily": "s gsc_daily_id; D date; i clicks impressions; d ctr position",
    "dim_date": _DATE,
    "dim_product": _PRODUCT,
    "dim_customer": _CUSTOMER + "; i customer_id",
    "dim_channel": _CHANNEL,
    "dim_shipping_method": _METHOD,
    "dim_material": _MATERIAL,
    "order_line_summary": "i order_id unit_count line_item_count; d calculated_gross",
    "fact_order": _ORDER_FACT,
    "discount_allocation": "i order_id line_number; d gross_line_revenue line_discount "
    "allocated_order_discount",
    "fact_order_line": _LINE_FACT,
    "fact_cogs_estimate": "s cogs_key order_line_key product_key material_key ingredient_name; "
    "d amount_ml cost_per_ml line_cost; b has_known_cost",
    "line_margin": "s order_line_key; d estimated_cogs gross_margin margin_percent; "
    "b has_missing_cost",
    "fact_marketing_spend": _MARKETING,
    "fact_gsc_daily": _SEARCH,
    "kpi_sales_summary": "D full_date; i year month week_of_year; s month_name day_name; "
    "b is_weekend; " + _SALES,
    "kpi_revenue_totals": _TOTALS,
    "kpi_product_profitability": "s internal_sku product_title cogs_status; i size_ml "
    "orders_containing_product units_sold; b is_active has_missing_cost; d list_price "
    "gross_revenue line_discounts allocated_order_discounts net_revenue total_estimated_cogs "
    "total_gross_margin margin_percent avg_selling_price",
    "kpi_cogs_detail": "s internal_sku product_title material_name material_category; "
    "b has_known_cost; d avg_amount_ml_per_unit cost_per_ml avg_cost_per_unit total_ml_used "
    "total_cost",
    "kpi_customer_segments": "s customer_segment; i customer_count total_orders; "
    "d total_revenue avg_customer_value avg_orders_per_customer",
    "kpi_new_vs_returning": "s customer_type; i orders unique_customers; d revenue "
    "avg_order_value",
    "kpi_repeat_purchase_rate": "i total_customers_with_orders one_time_customers "
    "repeat_customers; d avg_orders_per_customer avg_lifetime_value repeat_purchase_rate_percent",
    "kpi_shipping_methods": "s shipping_method_name; b is_local_delivery; i order_count; "
    "d revenue shipping_collected avg_order_value",
    "kpi_marketing_performance": "s campaign_name platform; i reach impressions link_clicks "
    "landing_page_views; d amount_spent cpm cpc ctr estimated_roas",
    "kpi_seo_performance": "D full_date; i week_of_year month clicks impressions; d ctr "
    "avg_position",
    "validation_order_totals": "i order_id; s order_number subtotal_validation total_validation; "
    "d gross_product_sales order_discount_amount subtotal calculated_subtotal subtotal_diff "
    "total_amount calculated_total total_diff",
    "export_fact_orders": _ORDER_FACT,
    "export_fact_order_lines": _LINE_FACT,
    "export_dim_date": _DATE,
    "export_dim_product": _PRODUCT,
    "export_dim_customer": _CUSTOMER,
    "export_dim_channel": _CHANNEL,
    "export_dim_shipping_method": _METHOD,
    "export_dim_material": _MATERIAL,
    "export_kpi_summary": "s period; " + _TOTALS,
    "export_fact_marketing": _MARKETING,
    "export_fact_seo_daily": _SEARCH,
    "dq_row_counts": "s table_name; i row_count",
    "dq_blank_ids": _CHECKS,
    "dq_blank_created_at": _CHECKS,
    "dq_unparsed_dates": _CHECKS,
    "dq_negative_amounts": _CHECKS,
    "dq_duplicate_keys": "s id; i count",
    "dq_unmapped_lines": "s lineitem_name; i line_count",
    "dq_sku_without_recipe": _CHECKS,
    "dq_subtotal": _CHECKS,
    "dq_total": _CHECKS,
    "dq_net_sales": _CHECKS,
    "dq_line_sum": "i order_id; d gross_product_sales line_gross diff",
    "dq_cogs_non_negative": _CHECKS,
    "dq_missing_cost_flag": "s order_line_key; i unknown_count",
    "dq_export_pii": _CHECKS + " forbidden_columns",
    "dq_hash_present": _CHECKS,
    "dq_unique_keys": _CHECKS,
    "dq_referential": _CHECKS,
    "dq_nulls_lengths": _CHECKS,
    "dq_rejected_values": _CHECKS,
    "load_summary": "i orders line_items customers products units; d revenue",
    "ext_sales_weekly": "D period_start; " + _SALES,
    "ext_sales_monthly": "D period_start; " + _SALES,
    "ext_week_over_week": "D period_start; i orders_count; d net_sales aov previous_net_sales "
    "previous_aov net_sales_change net_sales_change_percent aov_change",
    "ext_cohorts": "D cohort_month; i months_since customers orders; d revenue",
    "ext_ad_ratios": "s campaign_name; i impressions link_clicks; d amount_spent cpm cpc ctr",
    "ext_search_ctr": "i date_key clicks impressions; d ctr computed_ctr",
    "ext_attributed_roas": "s campaign_name; d amount_spent estimated_roas",
}


def columns_of(query: str) -> list[tuple[str, str]]:
    """Pairs of column name and type letter."""
    pairs = []
    for group in COLUMNS[query].split(";"):
        letter, *names = group.split()
        # A name may follow in a later group of another type letter.
        pairs += [(name, letter) for name in names]
    return pairs


def portable(query: str, df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(name).cast(SPARK_TYPES[letter]).alias(name) for name, letter in columns_of(query)]
    )


# ---- queries --------------------------------------------------------------------------

def _one_check(df: DataFrame, table: str, checks: dict, name: str) -> DataFrame:
    return quality.count_violations(df, table, {name: checks[name]})


def _channel_use(shop: Shop, channels: DataFrame) -> DataFrame:
    """Channels with the number of orders that resolve to them."""
    used = shop.fact_order.groupBy("channel_key").agg(F.count("*").alias("orders"))
    return channels.join(used, "channel_key", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


def _raw_row_counts(shop: Shop) -> DataFrame:
    return quality.row_counts(
        {
            "raw.orders": shop.raw_orders,
            "raw.product_sku_map": shop.raw_product_sku_map,
            "raw.material_costs": shop.raw_material_costs,
            "raw.recipes": shop.raw_recipes,
            "stg_orders": shop.stg_orders,
            "fact_order": shop.fact_order,
            "fact_order_line": shop.fact_order_line,
            "dim_product": shop.dim_product,
            "dim_customer": shop.dim_customer,
            "dim_date": shop.dim_date,
            "fact_cogs_estimate": shop.fact_cogs_estimate,
        }
    )


def _tables(shop: Shop, names: list[str]) -> dict[str, DataFrame]:
    return {name: getattr(shop, name) for name in names}


def _unique_keys(shop: Shop) -> DataFrame:
    return quality.unique_keys(_tables(shop, list(schemas.UNIQUE_KEYS)))


def _referential(shop: Shop) -> DataFrame:
    names = [
        "stg_orders", "dim_date", "dim_product", "dim_customer", "dim_channel",
        "dim_shipping_method", "dim_material", "fact_order", "fact_order_line",
        "fact_cogs_estimate", "fact_gsc_daily",
    ]
    # References of lines need no line numbers.
    return quality.referential(_tables(shop, names) | {"stg_order_lines": shop.line_rows})


def _nulls_lengths(shop: Shop) -> DataFrame:
    return quality.union(
        [
            quality.count_violations(getattr(shop, name), name, quality.declared_checks(name))
            for name in schemas.declared_tables()
        ]
    )


def _pii(shop: Shop) -> DataFrame:
    names = [
        "fact_order", "fact_order_line", "dim_date", "dim_product", "dim_customer", "dim_channel",
        "dim_shipping_method", "dim_material", "fact_marketing_spend", "fact_gsc_daily",
    ]
    tables = _tables(shop, names)
    tables["kpi_revenue_totals"] = marts.kpi_revenue_totals(shop.fact_order)
    return quality.personal_data(exports.all_exports(tables))


def _rejected(shop: Shop) -> DataFrame:
    """Values of every raw table that are not what a typed load expects."""
    return quality.union(
        [quality.rejected_values(getattr(shop, f"raw_{name}"), f"raw.{name}") for name in schemas.RAW_TYPES]
    )


def _weekly(shop: Shop) -> DataFrame:
    return extensions.sales_by_period(shop.dim_date, shop.fact_order, "week")


def _attributed(shop: Shop) -> DataFrame:
    revenue = (
        shop.table("events")
        .groupBy(F.col("event_type").alias("campaign_name"))
        .agg(F.sum(F.col("value").cast(C.MONEY) * 3).alias("revenue"))
    )
    return marts.kpi_marketing_performance(shop.fact_marketing_spend, revenue)


BUILDERS: dict[str, Callable[[Shop], DataFrame]] = {
    "header_normalise": lambda s: s.order_export.toDF(*clean_headers(s.order_export.columns)),
    "apostrophe_strip": lambda s: normalise(s.order_export),
    "stg_orders_dedupe": lambda s: staging.stg_orders(s.raw_orders),
    "stg_order_lines": lambda s: staging.stg_order_lines(s.raw_orders),
    "stg_products": lambda s: staging.stg_products(s.raw_products),
    "stg_customers": lambda s: staging.stg_customers(s.raw_customers),
    "stg_sku_map": lambda s: staging.stg_product_sku_map(s.raw_product_sku_map),
    "stg_material_costs": lambda s: staging.stg_material_costs(s.raw_material_costs),
    "stg_recipes": lambda s: s.stg_recipes,
    "stg_meta_ads": lambda s: s.stg_meta_ads,
    "stg_gsc_daily": lambda s: s.stg_gsc_daily,
    "dim_date": lambda s: s.dim_date,
    "dim_product": lambda s: s.dim_product,
    "dim_customer": lambda s: s.dim_customer,
    "dim_channel": lambda s: _channel_use(s, s.dim_channel),
    "dim_shipping_method": lambda s: s.dim_shipping_method,
    "dim_material": lambda s: s.dim_material,
    "order_line_summary": lambda s: facts.order_line_summary(s.line_rows),
    "fact_order": lambda s: s.fact_order,
    "discount_allocation": lambda s: facts.allocate_discounts(
        s.numbered_lines, s.fact_order, counted=s.line_rows
    ),
    "fact_order_line": lambda s: s.fact_order_line,
    "fact_cogs_estimate": lambda s: s.fact_cogs_estimate,
    "line_margin": lambda s: s.fact_order_line,
    "fact_marketing_spend": lambda s: s.fact_marketing_spend,
    "fact_gsc_daily": lambda s: s.fact_gsc_daily,
    "kpi_sales_summary": lambda s: marts.kpi_sales_summary(s.dim_date, s.fact_order, AS_OF),
    "kpi_revenue_totals": lambda s: marts.kpi_revenue_totals(s.fact_order),
    "kpi_product_profitability": lambda s: marts.kpi_product_profitability(
        s.dim_product, s.fact_order_line
    ),
    "kpi_cogs_detail": lambda s: marts.kpi_cogs_detail(
        s.dim_product, s.fact_order_line, s.recipe_costs, counted=s.stg_product_sku_map
    ),
    "kpi_customer_segments": lambda s: marts.kpi_customer_segments(s.dim_customer),
    "kpi_new_vs_returning": lambda s: marts.kpi_new_vs_returning(
        s.fact_order, s.dim_customer, s.dim_date
    ),
    "kpi_repeat_purchase_rate": lambda s: marts.kpi_repeat_purchase_rate(s.dim_customer),
    "kpi_shipping_methods": lambda s: marts.kpi_shipping_methods(
        s.fact_order, s.dim_shipping_method
    ),
    "kpi_marketing_performance": lambda s: marts.kpi_marketing_performance(s.fact_marketing_spend),
    "kpi_seo_performance": lambda s: marts.kpi_seo_performance(s.fact_gsc_daily, s.dim_date),
    "validation_order_totals": lambda s: marts.validation_order_totals(s.fact_order),
    "export_fact_orders": lambda s: exports.fact_orders(s.fact_order),
    "export_fact_order_lines": lambda s: exports.fact_order_lines(s.fact_order_line),
    "export_dim_date": lambda s: exports.whole(s.dim_date, "dim_date"),
    "export_dim_product": lambda s: exports.dim_product(s.dim_product),
    "export_dim_customer": lambda s: exports.dim_customer(s.dim_customer),
    "export_dim_channel": lambda s: _channel_use(s, exports.whole(s.dim_channel, "dim_channel")),
    "export_dim_shipping_method": lambda s: exports.whole(
        s.dim_shipping_method, "dim_shipping_method"
    ),
    "export_dim_material": lambda s: exports.whole(s.dim_material, "dim_material"),
    "export_kpi_summary": lambda s: exports.kpi_summary(marts.kpi_revenue_totals(s.fact_order)),
    "export_fact_marketing": lambda s: exports.whole(s.fact_marketing_spend, "fact_marketing"),
    "export_fact_seo_daily": lambda s: exports.fact_seo_daily(s.fact_gsc_daily),
    "dq_row_counts": _raw_row_counts,
    "dq_blank_ids": lambda s: _one_check(
        s.raw_orders, "raw.orders", quality.raw_order_checks(), "blank id"
    ),
    "dq_blank_created_at": lambda s: _one_check(
        s.raw_orders, "raw.orders", quality.raw_order_checks(), "blank created_at"
    ),
    "dq_unparsed_dates": lambda s: quality.union(
        [
            _one_check(
                s.raw_orders, "raw.orders", quality.raw_order_checks(), "created_at not a timestamp"
            ),
            _one_check(
                s.stg_orders, "stg_orders", quality.staged_order_checks(), "missing created_at"
            ),
        ]
    ),
    "dq_negative_amounts": lambda s: _one_check(
        s.stg_orders, "stg_orders", quality.staged_order_checks(), "negative amount"
    ),
    "dq_duplicate_keys": lambda s: quality.duplicate_keys(s.raw_orders, ["id"]),
    "dq_unmapped_lines": lambda s: quality.unmapped_lines(s.line_rows, s.stg_product_sku_map),
    "dq_sku_without_recipe": lambda s: _one_check(
        s.stg_product_sku_map, "stg_product_sku_map", quality.sku_map_checks(), "no recipe"
    ),
    "dq_subtotal": lambda s: _one_check(
        s.fact_order, "fact_order", quality.fact_order_checks(), "subtotal differs"
    ),
    "dq_total": lambda s: _one_check(
        s.fact_order, "fact_order", quality.fact_order_checks(), "total differs"
    ),
    "dq_net_sales": lambda s: _one_check(
        s.fact_order, "fact_order", quality.fact_order_checks(), "negative net sales"
    ),
    "dq_line_sum": lambda s: quality.line_sum_gaps(s.fact_order, s.fact_order_line),
    "dq_cogs_non_negative": lambda s: _one_check(
        s.fact_order_line, "fact_order_line", quality.fact_line_checks(), "negative cost"
    ),
    "dq_missing_cost_flag": lambda s: quality.wrong_cost_flags(
        s.fact_order_line, s.fact_cogs_estimate
    ),
    "dq_export_pii": _pii,
    "dq_hash_present": lambda s: _one_check(
        s.dim_customer, "dim_customer", quality.customer_checks(), "no hash"
    ),
    "dq_unique_keys": _unique_keys,
    "dq_referential": _referential,
    "dq_nulls_lengths": _nulls_lengths,
    "dq_rejected_values": _rejected,
    "load_summary": lambda s: load_summary(
        _tables(s, ["fact_order", "fact_order_line", "dim_customer", "dim_product"])
    ),
    "ext_sales_weekly": _weekly,
    "ext_sales_monthly": lambda s: extensions.sales_by_period(s.dim_date, s.fact_order, "month"),
    "ext_week_over_week": lambda s: extensions.week_over_week(_weekly(s)),
    "ext_cohorts": lambda s: extensions.customer_cohorts(s.fact_order, s.dim_customer),
    "ext_ad_ratios": lambda s: extensions.ad_ratios(s.fact_marketing_spend),
    "ext_search_ctr": lambda s: extensions.search_ctr(s.fact_gsc_daily),
    "ext_attributed_roas": _attributed,
}


def run(query: str, spark: SparkSession, folder: str) -> DataFrame:
    """The named query over the Parquet tables of a folder."""
    configure(spark)
    return portable(query, BUILDERS[query](Shop(spark, folder)))
