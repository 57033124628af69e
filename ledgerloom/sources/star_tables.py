"""A shop made of general star-schema tables (orders, lineitem, part, ...).

Lets every operator run on such tables: ``Shop`` offers the staging tables, and the raw
text tables that staging would have read. Everything is derived lazily from the files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import dimensions as D
from ledgerloom.operators import facts, staging


def _dec(c: str | Column, type_name: str = C.MONEY) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(type_name)


def _text(prefix: str, c: str | Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), (F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(suffix))


def as_text(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Every column as export text: NULL becomes blank."""
    return df.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias((rename or {}).get(c, c))
            for c in df.columns
        ]
    )


def _export_time(column: str) -> Column:
    """UTC timestamp as text with a -0500 offset."""
    local = F.col(column) - F.expr("INTERVAL 5 HOURS")
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(" -0500"))


class Shop:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # ---- staging tables ---------------------------------------------------------------

    @cached_property
    def line_rows(self) -> DataFrame:
        """Order lines before numbering."""
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "'#' || l_orderkey AS order_number",
            "'PART-' || l_partkey AS lineitem_name",
            "CASE WHEN l_partkey % 17 <> 0 THEN 'SKU-' || l_partkey END AS lineitem_sku",
            "CAST(l_quantity AS INT) AS lineitem_quantity",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS lineitem_price",
            "CAST(NULL AS DECIMAL(18,2)) AS lineitem_compare_at_price",
            "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))"
            " AS DECIMAL(18,2)) AS lineitem_discount",
            "l_linestatus AS lineitem_fulfillment_status",
            "'Vendor ' || l_suppkey AS vendor",
        )

    @cached_property
    def stg_order_lines(self) -> DataFrame:
        return staging.number_lines(self.line_rows)

    @cached_property
    def numbered_lines(self) -> DataFrame:
        """Numbered lines with the columns that facts use.

        Lines that agree in these may swap their numbers, which no fact can tell, so the other
        columns need not be sorted and shuffled.
        """
        return staging.number_lines(
            self.line_rows.select(
                "order_id", "lineitem_name", "lineitem_quantity", "lineitem_price", "lineitem_discount"
            )
        )

    @cached_property
    def stg_orders(self) -> DataFrame:
        """Orders whose amounts follow from their lines, with some that do not add up."""
        gross = facts.order_line_summary(self.line_rows).select(
            F.col("order_id").alias("o_orderkey"), "calculated_gross"
        )
        discounted = self.table("orders").join(gross, "o_orderkey", "left").selectExpr(
            "*",
            "CASE WHEN o_orderpriority = '1-URGENT' AND calculated_gross IS NOT NULL"
            " THEN CAST(calculated_gross * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2))"
            " ELSE CAST(0 AS DECIMAL(18,2)) END AS discount_amount",
        )
        priced = discounted.selectExpr(
            "*",
            "CASE WHEN o_orderkey % 50 = 0 OR calculated_gross IS NULL"
            " THEN CAST(o_totalprice AS DECIMAL(18,2))"
            " ELSE CAST(calculated_gross - discount_amount AS DECIMAL(18,2)) END AS subtotal",
        )
        taxed = priced.selectExpr(
            "*",
            "CAST(subtotal * CAST(0.08 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS taxes",
            # Some orders are paid back their shipping, some more than they cost.
            "CAST(CASE WHEN o_orderkey % 97 = 0 THEN -4 WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0"
            " ELSE 4 END AS DECIMAL(18,2)) AS shipping",
            "CAST(o_orderdate AS TIMESTAMP) AS created_at",
            "o_orderstatus = 'F' AS finished",
        )
        address = {
            "city": "'City ' || (o_custkey % 100)",
            "province": "'P' || (o_custkey % 25)",
            "country": "'US'",
            "zip": "lpad(CAST(o_custkey % 100000 AS STRING), 5, '0')",
        }
        return taxed.selectExpr(
            "o_orderkey AS order_id",
            "'#' || o_orderkey AS order_number",
            "CASE WHEN o_orderkey % 31 = 0 THEN ''"
            " WHEN o_orderkey % 2 = 0 THEN 'BUYER' || o_custkey || '@EXAMPLE.COM'"
            " ELSE 'Buyer' || o_custkey || '@Example.com' END AS email",
            "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending'"
            " ELSE 'partially_paid' END AS financial_status",
            "IF(finished, 'fulfilled', 'unfulfilled') AS fulfillment_status",
            "'USD' AS currency",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Express Local'"
            " WHEN '2-HIGH' THEN 'Local Delivery' WHEN '3-MEDIUM' THEN 'Economy'"
            " WHEN '5-LOW' THEN 'Standard' END AS shipping_method",
            "IF(o_orderkey % 40 = 0, 'High', 'Low') AS risk_level",
            "CASE o_orderkey % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'pos' WHEN 2 THEN 'API'"
            " WHEN 3 THEN 'Mobile App' END AS source",
            "'Card' AS payment_method",
            *[
                f"{expression} AS {kind}_{name}"
                for kind in ("billing", "shipping")
                for name, expression in address.items()
            ],
            "subtotal",
            "shipping",
            "taxes",
            "CAST(subtotal + shipping + taxes + IF(o_orderkey % 70 = 0, 1, 0) AS DECIMAL(18,2))"
            " AS total",
            "IF(o_orderpriority = '1-URGENT', 'RUSH5', NULL) AS discount_code",
            "discount_amount",
            "CAST(IF(finished AND o_orderkey % 20 = 0,"
            " subtotal * CAST(IF(o_orderkey % 60 = 0, 1.5, 0.5) AS DECIMAL(4,2)), 0)"
            " AS DECIMAL(18,2)) AS refunded_amount",
            "created_at",
            "IF(finished, created_at, NULL) AS paid_at",
            "IF(finished, created_at, NULL) AS fulfilled_at",
            "CAST(NULL AS TIMESTAMP) AS cancelled_at",
        )

    @cached_property
    def product_rows(self) -> DataFrame:
        """A product export: some handles are blank, some come twice with another title."""
        part = F.col("p_partkey")
        copies = F.when(part % 31 == 0, F.array(F.lit(""), F.lit(" (old)"))).otherwise(F.array(F.lit("")))
        return self.table("part").withColumn("copy", F.explode(copies)).select(
            F.when(part % 13 == 0, "").otherwise(_text("part-", part)).alias("handle"),
            F.concat("p_name", "copy").alias("title"),
            F.col("p_brand").alias("vendor"),
            F.col("p_type").alias("product_category"),
            F.col("p_type").alias("product_type"),
            F.lit("").alias("tags"),
            F.when(part % 17 != 0, _text("SKU-", part)).alias("variant_sku"),
            F.when(F.col("copy") == "", _dec("p_retailprice")).alias("variant_price"),
            F.lit(None).cast(C.MONEY).alias("variant_compare_at_price"),
            F.when(part % 41 != 0, F.col("p_size")).alias("variant_inventory_qty"),
            (part % 3 != 0).alias("is_published"),
            F.when(part % 3 != 0, "active").otherwise("draft").alias("status"),
        )

    @cached_property
    def sku_rows(self) -> DataFrame:
        """Most parts have a SKU, some a blank one, some a second one under the same line name."""
        part = F.col("p_partkey")
        spare = F.col("suffix") != ""
        suffixes = F.when(part % 29 == 0, F.array(F.lit(""), F.lit("-B"))).otherwise(F.array(F.lit("")))
        rows = self.table("part").withColumn("suffix", F.explode(suffixes))
        return rows.select(
            F.when(part % 17 == 0, "").otherwise(F.concat(_text("SKU-", part), F.col("suffix"))).alias(
                "internal_sku"
            ),
            _text("PART-", part).alias("lineitem_name"),
            _text("part-", part).alias("product_handle"),
            F.col("p_size").alias("size_ml"),
            F.when(part % 23 != 0, _text("REC-", part)).otherwise("").alias("recipe_id"),
            F.col("p_type").alias("product_category"),
            ((part % 10 != 0) & ~spare).alias("is_active"),
        )

    @cached_property
    def material_rows(self) -> DataFrame:
        """Every supplier stands for a material; some have a blank id, some a negative price."""
        key = F.col("s_suppkey")
        balance = F.abs(_dec("s_acctbal", "decimal(12,2)")) * F.when(key % 41 == 0, -1).otherwise(1)
        piece = key % 3 == 0
        return self.table("supplier").select(
            F.when(key % 37 == 5, "").otherwise(_text("MAT-", key)).alias("material_id"),
            F.col("s_name").alias("material_name"),
            _text("ING-", key).alias("ingredient_match"),
            F.when(piece, "Packaging").otherwise("Oil").alias("category"),
            F.when(piece, "piece").otherwise("ml").alias("unit"),
            F.when(piece, _dec(balance * F.expr("CAST(0.001 AS DECIMAL(4,3))"), C.RATE)).alias(
                "cost_per_unit"
            ),
            F.when(~piece, _dec(balance * F.expr("CAST(0.0001 AS DECIMAL(5,4))"), C.RATE)).alias(
                "cost_per_ml"
            ),
            (key % 5 != 0).alias("has_known_cost"),
            _text("Nation ", "s_nationkey").alias("supplier"),
        )

    @cached_property
    def recipe_rows(self) -> DataFrame:
        """Each part's own recipe: three ingredients from all suppliers, by arithmetic."""
        suppliers = self.table("supplier").agg(F.count("*")).scalar()
        k = F.pmod(F.col("p_partkey") * 3 + F.col("slot") * 7919, suppliers)
        slots = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("slot")
        known = self.table("part").select("p_partkey", "p_brand", "p_size", slots)
        known = known.select("p_partkey", "p_brand", "p_size", k.cast("int").alias("k"))
        k = F.col("k")
        amount = F.when(k % 3 != 0, _dec((k % 8 + 1) * F.expr("CAST(0.25 AS DECIMAL(4,2))"), C.RATE))
        # Recipes of one brand have a blank id.
        columns = [
            F.when(F.col("p_brand") == "Brand#7", "").otherwise(_text("REC-", "p_partkey")).alias("recipe_id"),
            _text("Recipe ", "p_partkey").alias("recipe_name"),
        ]
        final = known.select(
            *columns,
            F.explode(F.array(F.lit("final"), F.lit("draft"))).alias("variant"),
            F.col("p_size").alias("batch_size_ml"),
            _text("ING-", k).alias("ingredient_match"),
            F.lit(None).cast(C.RATE).alias("percent"),
            amount.alias("amount_ml"),
            _text("MAT-", k).alias("material_id"),
        )
        unlisted = self.table("part").where("p_size % 10 = 3").select(
            *columns,
            F.lit("final").alias("variant"),
            F.col("p_size").alias("batch_size_ml"),
            F.lit("ING-X").alias("ingredient_match"),
            F.lit(None).cast(C.RATE).alias("percent"),
            F.lit(1).cast(C.RATE).alias("amount_ml"),
            F.lit("MAT-X").alias("material_id"),
        )
        return final.unionByName(unlisted)

    @cached_property
    def customer_rows(self) -> DataFrame:
        """Every customer; some profiles have a blank id, some another's, some odd texts."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            F.when(key % 9 != 0, F.when(key % 50 == 8, key - 1).otherwise(key)).alias("customer_id"),
            F.lit("First").alias("first_name"),
            F.when(key % 60 == 11, F.repeat("c_name", F.lit(8))).otherwise(F.col("c_name")).alias("last_name"),
            _text("buyer", key, "@example.com").alias("email"),
            (key % 2 == 0).alias("accepts_email_marketing"),
            (key % 3 == 0).alias("accepts_sms_marketing"),
            F.when(key % 80 == 3, _text("c/o buyer", key, "@example.com"))
            .otherwise(_text("City ", key % 100))
            .alias("city"),
            _text("P", "c_nationkey").alias("province"),
            _text("P", "c_nationkey").alias("province_code"),
            F.lit("US").alias("country"),
            F.lit("US").alias("country_code"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("zip"),
            F.when(key % 43 != 0, F.abs(_dec("c_acctbal"))).alias("total_spent"),
            F.when(key % 47 != 0, (key % 7).cast("int")).alias("total_orders"),
        )

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw_products)

    @cached_property
    def stg_product_sku_map(self) -> DataFrame:
        return staging.stg_product_sku_map(self.raw_product_sku_map)

    @cached_property
    def stg_material_costs(self) -> DataFrame:
        return staging.stg_material_costs(self.raw_material_costs)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def stg_recipes(self) -> DataFrame:
        return staging.stg_recipes(self.raw_recipes)

    @cached_property
    def ad_rows(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("campaign_name"))
            .agg(
                F.count_distinct("user_id").alias("reach"),
                F.count("*").alias("impressions"),
                F.sum(_dec("value")).alias("amount_spent"),
                F.expr("count(*) DIV 7").alias("link_clicks"),
                F.expr("count(*) DIV 11").alias("landing_page_views"),
            )
        )

    @cached_property
    def search_rows(self) -> DataFrame:
        """Clicks, impressions, click rate in hundredths of a percent, and position per day."""
        clicks = F.count_if(F.col("event_type") == "click")
        basis = F.call_function("div", clicks * 10000, F.count("*"))
        place = F.sum(F.col("event_id") % 100)
        position = F.call_function("div", place * 100, F.count("*"))
        cent = F.expr("CAST(0.01 AS DECIMAL(4,2))")
        return (
            self.table("events")
            .groupBy(F.to_date("ts").alias("date"))
            .agg(
                clicks.alias("clicks"),
                F.count("*").alias("impressions"),
                _dec(basis * cent).alias("ctr_percent"),
                _dec(position * cent).alias("position"),
            )
        )

    @cached_property
    def stg_meta_ads(self) -> DataFrame:
        return staging.stg_meta_ads(self.raw_meta_ads)

    @cached_property
    def stg_gsc_daily(self) -> DataFrame:
        return staging.stg_gsc_daily(self.raw_gsc_daily)

    # ---- raw text tables --------------------------------------------------------------

    @cached_property
    def order_export(self) -> DataFrame:
        """An order export as it arrives: human headers, repeated orders, guarded zips."""
        times = ("created_at", "paid_at", "fulfilled_at", "cancelled_at")
        orders = self.stg_orders.withColumns({c: _export_time(c) for c in times})
        # Orders become text and are repeated before they meet their lines, not once a line.
        names = as_text(orders, {"order_id": "id", "order_number": "name"})
        text = names.withColumn("order", F.col("id").cast("bigint"))
        # Some lines are repeated without order amounts; some rows have no id at all.
        order = F.col("order")
        copies = (
            F.when(order % 7 == 0, F.array(F.lit("full"), F.lit("bare"), F.lit("no id")))
            .otherwise(F.array(F.lit("full")))
        )
        bare, no_id = F.col("copy") == "bare", F.col("copy") == "no id"
        text = text.withColumn("copy", F.explode(copies)).withColumns(
            {
                "id": F.when(no_id, "").otherwise(F.col("id")),
                # A row without an id holds text where numbers and times should be.
                "subtotal": F.when(bare, "").when(no_id & (order % 5 == 0), "n/a").otherwise(F.col("subtotal")),
                "created_at": F.when(no_id & (order % 3 == 0), "not recorded")
                .when(no_id & (order % 3 == 1), "")
                .otherwise(F.col("created_at")),
                "billing_zip": F.concat(F.lit("'"), "billing_zip"),
                "shipping_zip": F.concat(F.lit("'"), "shipping_zip"),
            }
        )
        lines = self.line_rows.drop("order_number").withColumnRenamed("order_id", "order")
        written = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lines.columns if c != "order"}
        written["lineitem_quantity"] = F.when(no_id & (order % 2 == 0), "two").otherwise(written["lineitem_quantity"])
        written["lineitem_name"] = F.when(bare, "").otherwise(written["lineitem_name"])
        text = text.join(lines, "order", "left").select(
            *names.columns, *[value.alias(c) for c, value in written.items()]
        )
        return text.toDF(*[c.replace("_", " ").capitalize() for c in text.columns])

    @cached_property
    def raw_orders(self) -> DataFrame:
        from ledgerloom.sources.csv import normalise

        return normalise(self.order_export)

    @cached_property
    def raw_products(self) -> DataFrame:
        return as_text(self.product_rows, {"product_type": "type", "is_published": "published"})

    @cached_property
    def raw_customers(self) -> DataFrame:
        df = self.customer_rows.drop("province", "country")
        yes_no = {
            c: F.when(F.col(c), "yes").otherwise("no")
            for c in ("accepts_email_marketing", "accepts_sms_marketing")
        }
        address = {c: f"default_address_{c}" for c in ("city", "province_code", "country_code", "zip")}
        return as_text(df.withColumns(yes_no), address)

    @cached_property
    def raw_product_sku_map(self) -> DataFrame:
        return as_text(self.sku_rows)

    @cached_property
    def raw_material_costs(self) -> DataFrame:
        return as_text(self.material_rows)

    @cached_property
    def raw_recipes(self) -> DataFrame:
        return as_text(self.recipe_rows)

    @cached_property
    def ad_export(self) -> DataFrame:
        """An advertising export as it arrives: human headers, money with signs, some ratios."""
        def rate(units: str) -> str:
            return f"CAST(({units}) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))"

        rated = "campaign_name NOT IN ('click', 'view')"
        cents = "CAST(amount_spent * 100 AS BIGINT)"
        text = as_text(
            self.ad_rows.selectExpr(
                "* EXCEPT (amount_spent)",
                "concat('$', format_number(amount_spent, 2)) AS amount_spent",
                rate("IF(reach > 0, impressions * 10000 DIV reach, NULL)") + " AS frequency",
                rate(f"IF({rated}, {cents} * 100000 DIV impressions, NULL)") + " AS cpm",
                rate(f"IF({rated} AND link_clicks > 0, {cents} * 100 DIV link_clicks, NULL)") + " AS cpc",
                rate(f"IF({rated}, link_clicks * 1000000 DIV impressions, NULL)") + " AS ctr",
            )
        )
        headers = {
            "campaign_name": "Campaign name", "amount_spent": "Amount spent (USD)", "link_clicks": "Link clicks",
            "cpm": "CPM (cost per 1,000 impressions)", "cpc": "CPC (cost per link click)",
            "ctr": "CTR (link click-through rate)", "landing_page_views": "Landing page views",
        }
        return text.select(*[F.col(c).alias(headers.get(c, c.capitalize())) for c in text.columns])

    @cached_property
    def raw_meta_ads(self) -> DataFrame:
        from ledgerloom.sources.csv import ads_columns, normalise

        return ads_columns(normalise(self.ad_export))

    @cached_property
    def raw_gsc_daily(self) -> DataFrame:
        df = self.search_rows.withColumn("ctr", _text("", "ctr_percent", "%")).drop("ctr_percent")
        return as_text(df)

    # ---- star schema ------------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar over all order and event days."""
        days = self.table("orders").agg(
            F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
        ).unionByName(self.table("events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")))
        ends = days.select(F.explode(F.array("a", "b")).alias("day"))
        return D.calendar_of(ends, "day")

    @cached_property
    def dim_product(self) -> DataFrame:
        return D.dim_product(self.stg_product_sku_map, self.stg_products)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return D.dim_customer(self.stg_orders, self.stg_customers)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return D.dim_channel(self.spark)

    @cached_property
    def dim_shipping_method(self) -> DataFrame:
        return D.dim_shipping_method(self.stg_orders)

    @cached_property
    def dim_material(self) -> DataFrame:
        return D.dim_material(self.stg_material_costs)

    @cached_property
    def recipe_costs(self) -> DataFrame:
        recipes = staging.recipe_ingredients(self.raw_recipes)
        return facts.recipe_costs(recipes, self.stg_material_costs)

    @cached_property
    def numbered_costs(self) -> DataFrame:
        return facts.recipe_costs(
            self.stg_recipes, self.stg_material_costs,
            counted=staging.recipe_ingredients(self.raw_recipes),
        )

    @cached_property
    def fact_order(self) -> DataFrame:
        return facts.fact_order(self.stg_orders, self.line_rows, self.dim_shipping_method)

    @cached_property
    def product_keys(self) -> DataFrame:
        """Line names with the key of the product each stands for."""
        names = facts.sku_by_line_name(self.stg_product_sku_map)
        return names.select("lineitem_name", C.surrogate(F.col("internal_sku")).alias("product_key"))

    @cached_property
    def product_costs(self) -> DataFrame:
        return facts.product_costs(self.stg_product_sku_map, self.recipe_costs)

    @cached_property
    def fact_order_line(self) -> DataFrame:
        return facts.fact_order_line(
            self.numbered_lines, self.fact_order, self.product_costs, counted=self.line_rows
        )

    @cached_property
    def fact_cogs_estimate(self) -> DataFrame:
        return facts.fact_cogs_estimate(
            self.fact_order_line, self.dim_product, self.numbered_costs,
            counts=facts.lines_per_product(self.line_rows, self.product_keys),
            counted=self.stg_product_sku_map,
        )

    @cached_property
    def fact_marketing_spend(self) -> DataFrame:
        return facts.fact_marketing_spend(self.stg_meta_ads)

    @cached_property
    def fact_gsc_daily(self) -> DataFrame:
        return facts.fact_gsc_daily(self.stg_gsc_daily)
