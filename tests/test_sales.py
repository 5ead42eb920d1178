"""Allocation, marts and skew."""

import datetime as dt
import random
from collections import defaultdict

from tallyhouse.operators import marts, sales
from tallyhouse.plans.medallion import Layer, Model, gold_over

DAY = dt.date(2024, 3, 5)
LINES = (
    "order_item_id long, order_id long, order_date date, is_revenue_order boolean,"
    " product_id long, product_name string, variant_id long, sku string, quantity long,"
    " discount_cents long, line_total_cents long, cogs_cents long, gross_margin_cents long"
)
REFUNDS = "order_id long, order_date date, refund_cents long, is_completed boolean"


def lines(spark, rows):
    """rows: (item, order, product, variant, line total[, revenue])"""
    full = [
        (item, order, DAY, revenue[0] if revenue else True, product, f"P{product}", variant,
         f"S{variant}", 1, 0, cents, cents // 4, cents - cents // 4)
        for item, order, product, variant, cents, *revenue in rows
    ]
    return spark.createDataFrame(full, LINES)


def refunds(spark, rows):
    return spark.createDataFrame([(o, DAY, cents, done) for o, cents, done in rows], REFUNDS)


def test_equal_thirds_are_not_rebalanced(spark):
    items = lines(spark, [(1, 1, 1, 1, 50), (2, 1, 2, 2, 50), (3, 1, 3, 3, 50)])
    shares = sales.line_refunds(items, refunds(spark, [(1, 100, True)])).collect()
    assert [row.refund_cents for row in shares] == [33, 33, 33]


def test_several_refunds_pending_ones_and_zero_lines(spark):
    items = lines(
        spark,
        [(1, 1, 1, 1, 100), (2, 1, 1, 2, 300), (3, 2, 1, 1, 0), (4, 2, 2, 3, 0),
         (5, 3, 1, 1, 70), (6, 4, 1, 1, 500, False)],
    )
    refunded = refunds(
        spark,
        [(1, 40, True), (1, 60, True), (1, 999, False), (2, 50, True), (4, 10, True), (9, 5, True)],
    )
    mart = {row.product_id: row for row in sales.mart_product_sales(items, refunded).collect()}
    first = mart[1]
    assert first.gross_revenue_cents == 470 and first.refund_cents == 100
    assert first.net_revenue_cents == 370
    assert (first.sku_count, first.order_count, first.units_sold) == (2, 3, 4)
    assert mart[2].refund_cents == 0 and mart[2].gross_margin_pct is None


def test_one_order_with_a_third_of_all_lines(spark):
    """The join is split by AQE, and the result is whole and right."""
    rng = random.Random(5)
    rows, item = [], 0
    for number in range(6000):
        order = 1 if number % 3 == 0 else rng.randrange(2, 900)
        item += 1
        rows.append((item, order, rng.randrange(40), rng.randrange(120), rng.randrange(1, 9999)))
    refunded = [(1, 123_457, True)] + [(o, rng.randrange(1, 5000), True) for o in range(2, 400)]

    whole = defaultdict(int)
    for _, order, _, _, cents in rows:
        whole[order] += cents
    due = defaultdict(int)
    for order, cents, _ in refunded:
        due[order] += cents
    expected = defaultdict(int)
    for _, order, product, _, cents in rows:
        expected[product] += int(due[order] * (cents / whole[order]) + 0.5) if due[order] else 0

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = lines(spark, rows).repartition(8)
        shares = sales.line_refunds(items, refunds(spark, refunded))
        by_product = shares.groupBy("product_id").sum("refund_cents")
        found = {row[0]: row[1] for row in by_product.collect()}
        plan = by_product._jdf.queryExecution().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert found == {product: cents for product, cents in expected.items()}
    assert "skew=true" in plan


def test_refunds_and_reviews_land_on_the_order_day(spark):
    orders = spark.createDataFrame(
        [(1, DAY, True, 1000), (2, DAY, True, 500), (3, DAY, False, 700)],
        "order_id long, order_date date, is_revenue_order boolean, total_cents long",
    ).selectExpr(
        "*", "total_cents as subtotal_cents", "0L as discount_cents", "0L as shipping_cents",
        "0L as tax_cents",
    )
    refunded = refunds(spark, [(1, 100, True), (1, 50, True), (2, 0, True), (3, 9, True)])
    reviews = spark.createDataFrame(
        [(DAY, 5), (DAY, 2), (dt.date(2024, 3, 6), 1)], "review_date date, rating int"
    )
    rows = sales.mart_daily_sales(orders, refunded, reviews).collect()
    assert len(rows) == 1, "a day with reviews only is not in the mart"
    row = rows[0]
    assert (row.order_count, row.gmv_cents, row.refund_cents) == (2, 1500, 150)
    assert row.refunded_order_count == 1 and row.net_revenue_cents == 1350
    assert row.aov_cents == 750.0 and row.refund_rate == 0.1
    assert row.review_count == 2 and row.avg_rating == 3.5


def test_lines_are_not_shuffled_by_order_for_the_sums(spark):
    """Only the refund side may exchange on order_id."""
    items = lines(spark, [(1, 1, 1, 1, 50)])
    sold = sales.sales_by(
        items, sales.line_refunds(items, refunds(spark, [(1, 100, True)])), "product_id"
    )
    plan = sold._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Expand" not in plan


def test_product_mart_counts_without_copying_lines(spark):
    """Two distinct counts, without a plan that makes a row per line and count."""
    items = lines(spark, [(1, 1, 1, 1, 50), (2, 1, 1, 2, 30), (3, 2, 1, 1, 20), (4, 2, None, 9, 5)])
    mart = sales.mart_product_sales(items, refunds(spark, [(1, 10, True)]))
    assert "Expand" not in mart._jdf.queryExecution().optimizedPlan().toString()
    found = {row.product_id: row for row in mart.collect()}
    assert (found[1].sku_count, found[1].order_count, found[1].gross_revenue_cents) == (2, 2, 100)
    assert (found[None].sku_count, found[None].order_count) == (1, 1)


def test_product_mart_is_not_joined_at_its_grain(spark):
    """Refund shares are stacked with the sums; a missing product has none, as in a join."""
    items = lines(
        spark,
        [(1, 1, 1, 1, 50), (2, 1, 1, 2, 30), (3, 1, 1, 2, 20), (4, 2, 1, 2, 10), (5, 2, None, 9, 5), (6, None, 1, 1, 7)],
    )
    refunded = refunds(spark, [(1, 10, True), (2, 9, True)])
    for mart, key in ((sales.mart_product_sales, "product_id"), (marts.variant_sales, "variant_id")):
        made = mart(items, refunded)
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 2, "order totals with refunds, and lines with those"
        found = {row[key]: row for row in made.collect()}
        if key == "product_id":
            one, none = found[1], found[None]
            assert (one.sku_count, one.order_count, one.units_sold, one.refund_cents) == (2, 2, 5, 16)
            assert one.net_revenue_cents == 101
            assert (none.sku_count, none.order_count, none.refund_cents) == (1, 1, 0)
        else:
            assert {k: (r.order_count, r.refund_cents) for k, r in found.items()} == {1: (1, 5), 2: (2, 11), 9: (1, 3)}


def test_lines_of_lazy_silver_are_made_once_a_write(spark, given):
    items = lines(spark, [(1, 1, 1, 1, 50), (2, 1, 1, 2, 30), (3, 2, 1, 1, 20)])
    refunded = refunds(spark, [(1, 10, True)])
    facts = {"fct_order_items": Model(lambda: items), "fct_refunds": Model(lambda: refunded)}
    kept_before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name, reads in (("mart_product_sales", 4), ("mart_variant_sales", 3)):
        wanted = gold_over(given(fct_order_items=items, fct_refunds=refunded)).build(name)
        with gold_over(Layer(facts, given())).made(name) as frame:
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("InMemoryRelation") == reads
            assert sorted(frame.collect()) == sorted(wanted.collect())
        with gold_over(given(fct_order_items=items, fct_refunds=refunded)).made(name) as frame:
            assert "InMemoryRelation" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept_before
