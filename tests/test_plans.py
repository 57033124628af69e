"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.hotkeys import busy_keys, find_busy, join_busy, rows_per_key
from ledgerloom.operators import dimensions as D
from ledgerloom.operators import facts, marts, staging
from ledgerloom.plans import queries
from ledgerloom.sources.star_tables import Shop

FOLDER = "/root/testdata/sf0.001"


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LINES = 6_000


def skewed_lines(spark):
    """A third of the lines are in order 0 and another third are of one product."""
    n = F.col("id")
    return spark.range(LINES).select(
        F.when(n % 3 == 0, 0).otherwise(n % 1999).alias("order_id"),
        F.floor(n / 1999).alias("line_number"),
        F.concat(F.lit("p"), F.when(n % 3 == 1, 0).otherwise(n % 401).cast("string")).alias("lineitem_name"),
        F.lit(2).alias("lineitem_quantity"),
        F.lit("1.50").cast("decimal(10,2)").alias("lineitem_price"),
        F.lit(0).cast("decimal(10,2)").alias("lineitem_discount"),
    )


def orders_of(lines):
    return lines.groupBy("order_id").agg(
        F.sum("lineitem_quantity").alias("gross"), F.count("*").alias("line_item_count")
    ).select(
        "order_id",
        "line_item_count",
        F.col("order_id").alias("order_key"),
        F.lit(20250101).alias("order_date_key"),
        F.lit("7.77").cast("decimal(10,2)").alias("order_discount_amount"),
        F.col("gross").cast("decimal(18,2)").alias("gross_product_sales"),
    )


def product_rows(spark):
    """Products of three lines out of four; product p0 is one of them."""
    return spark.range(401).where("id % 4 <> 3").select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("lineitem_name"),
        F.md5(F.col("id").cast("string")).alias("product_key"),
        F.lit(1).cast("decimal(18,4)").alias("unit_cogs"),
        F.lit(False).alias("unit_missing_cost"),
    )


def same(whole, split) -> None:
    assert whole.count() == split.count() > 0
    assert whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0


@pytest.mark.parametrize("shares", [6, 50, 10**5])
def test_hot_order_and_hot_product_give_the_same_lines(spark, shares):
    lines, products = skewed_lines(spark), product_rows(spark)
    orders = orders_of(lines)
    whole = facts.fact_order_line(lines, orders, products, shares=1)
    assert whole.count() == LINES
    same(whole, facts.fact_order_line(lines, orders, products, shares=shares))


def test_busy_keys_are_bounded_by_shares(spark):
    lines = skewed_lines(spark)
    for shares in (2, 6, 100, 10**6):
        busy = busy_keys(rows_per_key(lines, ["order_id"]), ["order_id"], shares).collect()
        assert len(busy) < shares and all(r["_rows"] * shares > LINES for r in busy)
    assert [r["order_id"] for r in busy_keys(rows_per_key(lines, ["order_id"]), ["order_id"], 6).collect()] == [0]
    assert busy_keys(rows_per_key(lines.limit(0), ["order_id"]), ["order_id"]).collect() == []


def test_rows_of_a_hot_key_are_dealt_to_many_tasks(spark):
    """No task of the join receives more than a few shares of the lines; rows without a key
    are dealt as well."""
    lines = skewed_lines(spark).withColumn("order_id", F.when(F.col("order_id") != 7, F.col("order_id")))
    lines = lines.withColumn("order_id", F.when(F.col("line_number") % 2 == 0, F.col("order_id")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        orders = orders_of(lines.where("order_id IS NOT NULL"))
        joined = join_busy(lines, orders, ["order_id"], ["line_number", "lineitem_name"], "left", shares=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < LINES / 16 * 3
        assert "SortMergeJoin" in initial_plan(joined)
        same(lines.join(orders, "order_id", "left").select(*joined.columns), joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def jobs_started_by(spark, work) -> int:
    spark.sparkContext.setJobGroup("plans", "building plans")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plans"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", list(queries.BUILDERS))
def test_no_job_runs_while_a_plan_is_built(spark, name):
    shop = Shop(spark, FOLDER)
    for table in ("region nation customer supplier part orders lineitem events").split():
        shop.table(table)  # reading footers is a job of its own
    assert jobs_started_by(spark, lambda: queries.BUILDERS[name](shop)) == 0


def test_hot_customer_gives_the_same_counts(spark):
    n = F.col("id")
    orders = spark.range(LINES).select(
        n.alias("order_id"),
        F.concat(F.lit("c"), F.when(n % 3 == 0, 0).otherwise(n % 97).cast("string")).alias("customer_key"),
        (F.lit(20250101) + n % 5).cast("int").alias("order_date_key"),
        F.lit(1).cast("decimal(10,2)").alias("net_sales"),
    )
    customers = orders.groupBy("customer_key").agg(
        F.count("*").alias("total_orders"), F.lit("2025-01-02").cast("date").alias("first_order_date")
    )
    days = spark.range(3).select(
        (F.lit(20250101) + n).cast("int").alias("date_key"),
        F.date_add(F.lit("2025-01-01").cast("date"), n.cast("int")).alias("full_date"),
    )
    whole = marts.kpi_new_vs_returning(orders, customers, days, shares=1).orderBy("customer_type").collect()
    split = marts.kpi_new_vs_returning(orders, customers, days, shares=12)
    assert split.orderBy("customer_type").collect() == whole
    assert sum(r["orders"] for r in whole) == LINES * 3 // 5


def test_hot_product_gives_the_same_cost_rows(spark):
    lines = skewed_lines(spark)
    fact = facts.fact_order_line(lines, orders_of(lines), product_rows(spark))
    dim = product_rows(spark).select("product_key", F.lit("r").alias("recipe_id"), F.lit(5).alias("size_ml"))
    costs = spark.range(3).select(
        F.lit("r").alias("recipe_id"), F.lit(5).alias("size_ml"), F.col("id").alias("recipe_line"),
        F.lit("m").alias("material_key"), F.lit("i").alias("ingredient_name"),
        *[F.lit(1).cast("decimal(10,4)").alias(c) for c in ("amount_ml", "cost_per_ml", "line_cost")],
        F.lit(True).alias("has_known_cost"),
    )
    whole = facts.fact_cogs_estimate(fact, dim, costs, shares=1)
    split = facts.fact_cogs_estimate(fact, dim, costs, shares=6)
    assert whole.count() == split.count() > LINES
    assert whole.exceptAll(split).count() == 0


def test_dedupe_cuts_groups_before_the_exchange(spark):
    shop = Shop(spark, FOLDER)
    plan = initial_plan(staging.stg_orders(shop.raw_orders))
    before_exchange = plan[plan.index("WindowGroupLimit"):]
    assert re.search(r"WindowGroupLimit .*Final", plan)
    assert re.search(r"Exchange hashpartitioning\(id.*\n.*WindowGroupLimit .*Partial", before_exchange)


def test_repeated_orders_are_one_row_before_they_are_sorted(spark):
    shop = Shop(spark, FOLDER)
    plan = initial_plan(staging.stg_orders(shop.raw_orders))
    assert re.search(r"WindowGroupLimit .*Partial\n.*Sort .*\n.*HashAggregate\(keys=", plan)
    row = shop.raw_orders.where("id <> '' AND subtotal <> ''").limit(1)
    repeated = row.unionByName(row).unionByName(row.withColumn("subtotal", F.lit("")))
    assert staging.stg_orders(repeated).collect() == staging.stg_orders(row).collect()


def test_export_writes_orders_before_they_meet_lines(spark):
    """Orders become text and are repeated below the join with their lines."""
    plan = initial_plan(Shop(spark, FOLDER).order_export)
    assert re.search(r"Join \[order#\S+\], \[order#\S+\], LeftOuter", plan)
    assert plan.index("LeftOuter") < plan.index("Generate explode") and plan.count("Generate explode") == 1


def test_scans_read_needed_columns_only(spark, tmp_path):
    shop = Shop(spark, FOLDER)
    shop.fact_order.write.parquet(str(tmp_path / "fact_order"))
    fact = spark.read.parquet(str(tmp_path / "fact_order"))
    plan = initial_plan(marts.kpi_shipping_methods(fact, D.dim_shipping_method(shop.stg_orders)))
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan)
    read = [s for s in scans if "shipping_method_key" in s]
    assert len(read) == 1
    assert {re.sub("#.*", "", c) for c in read[0].split(",")} == {
        "order_id", "shipping_method_key", "shipping_amount", "net_sales",
    }
    returning = initial_plan(marts.kpi_new_vs_returning(fact, shop.dim_customer, shop.dim_date))
    assert "DataFilters: [isnotnull(customer_key" in returning


def test_shipping_methods_need_no_order_lines(spark):
    plan = initial_plan(D.dim_shipping_method(Shop(spark, FOLDER).stg_orders))
    assert "lineitem" not in plan and "l_orderkey" not in plan


def test_profitability_combines_before_it_shuffles(spark):
    shop = Shop(spark, FOLDER)
    plan = initial_plan(marts.kpi_product_profitability(shop.dim_product, shop.fact_order_line))
    assert "partial_sum" in plan and "partial_count" in plan
    assert "keys=[product_key" in plan and not re.search(r"keys=\[product_key#\d+, order_", plan)


def test_unused_line_numbers_cost_nothing(spark):
    """Totals of orders do not sort lines to number them."""
    plan = initial_plan(marts.kpi_revenue_totals(Shop(spark, FOLDER).fact_order))
    assert "row_number() windowspecdefinition(order_id" not in plan


def test_hot_recipe_material_and_handle_give_the_same_rows(spark):
    """Half of all SKUs share a recipe and a shop product, half of all recipe rows a material."""
    n = F.col("id")
    skus = spark.range(400).select(
        F.concat(F.lit("s"), n.cast("string")).alias("internal_sku"),
        F.concat(F.lit("l"), n.cast("string")).alias("lineitem_name"),
        F.concat(F.lit("h"), F.when(n % 2 == 0, 0).otherwise(n).cast("string")).alias("product_handle"),
        F.lit(5).alias("size_ml"),
        F.concat(F.lit("r"), F.when(n % 2 == 0, 0).otherwise(n % 9).cast("string")).alias("recipe_id"),
        F.lit("c").alias("product_category"),
        F.lit(True).alias("is_active"),
    )
    shop = spark.range(0, 400, 3).select(
        F.concat(F.lit("h"), n.cast("string")).alias("handle"),
        F.lit("v").alias("vendor"),
        F.lit(1).cast("decimal(10,2)").alias("variant_price"),
    )
    recipes = spark.range(60).select(
        F.concat(F.lit("r"), (n % 10).cast("string")).alias("recipe_id"), F.lit("final").alias("variant"),
        F.lit(5).alias("batch_size_ml"), n.alias("recipe_line"), n.cast("string").alias("ingredient_match"),
        F.lit(2).cast("decimal(10,4)").alias("amount_ml"),
        F.concat(F.lit("m"), F.when(n % 2 == 0, 0).otherwise(n).cast("string")).alias("material_id"),
    )
    materials = spark.range(0, 60, 4).select(
        F.concat(F.lit("m"), n.cast("string")).alias("material_id"), n.cast("string").alias("material_name"),
        F.lit("c").alias("category"), n.cast("decimal(10,4)").alias("cost_per_ml"),
        F.lit(None).cast("decimal(10,4)").alias("cost_per_unit"), F.lit(True).alias("has_known_cost"),
    )

    costs = facts.recipe_costs(recipes, materials, shares=1)
    same(costs, facts.recipe_costs(recipes, materials, 3))
    same(costs, facts.recipe_costs(recipes, materials, 10**4))
    whole = facts.product_costs(skus, costs, shares=1)
    same(whole, facts.product_costs(skus, costs, 8))
    products = D.dim_product(skus, shop, shares=1)
    same(products, D.dim_product(skus, shop, shares=8))
    same(products, D.dim_product(skus, shop, shares=10**4))
    few = products.select("product_key", "recipe_id", "size_ml")
    same(facts.product_ingredients(few, costs, 1), facts.product_ingredients(few, costs, 8))


def test_busy_keys_are_found_by_bucket(spark):
    """The same keys as by counting each, NULL among them; keys that come a few times are not shuffled."""
    lines = skewed_lines(spark).withColumn("order_id", F.when(F.col("order_id") != 7, F.col("order_id")))
    for keys in (["order_id"], ["order_id", "lineitem_name"]):
        for shares in (6, 8192):
            want = busy_keys(rows_per_key(lines, keys), keys, shares)
            got = find_busy(lines, keys, shares)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    many = spark.range(200_000).selectExpr("id % 100000 AS k")
    within = find_busy(many, ["k"])
    assert within.collect() == []
    assert "_bucket" in initial_plan(join_busy(many, many.distinct(), ["k"], ["k"]))


def test_facts_number_only_the_columns_they_use(spark):
    shop = Shop(spark, FOLDER)
    plan = initial_plan(shop.fact_order_line)
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan)
    assert not any("l_suppkey" in s or "l_linestatus" in s for s in scans)
    want = facts.fact_order_line(shop.stg_order_lines, shop.fact_order, shop.product_costs)
    same(want, shop.fact_order_line)
