import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import lookups, marts
from tallyhouse.operators.analytics import resolve_range
from tallyhouse.session import shared_folder

ORDERS = "order_id long, customer_id long, order_date date, total_cents long, is_revenue_order boolean"


def orders(spark, rows):
    return spark.createDataFrame([(*row, True) for row in rows], ORDERS)


def test_second_order_on_the_first_day_is_a_repeat(spark):
    d1, d2 = dt.date(2024, 1, 30), dt.date(2024, 3, 1)
    frame = orders(spark, [(1, 1, d1, 10), (2, 1, d1, 10), (3, 2, d1, 10), (4, 1, d2, 10)])
    rows = {row.order_date: row for row in marts.customer_activity(frame).collect()}
    assert (rows[d1].new_buyers, rows[d1].new_customer_orders, rows[d1].returning_customer_orders) == (2, 2, 1)
    assert (rows[d2].new_buyers, rows[d2].returning_buyers) == (0, 1)
    cohorts = {row.period_number: row for row in marts.customer_cohorts(frame).collect()}
    assert set(cohorts) == {0, 2}, "January 30 to March 1 is two months on"
    assert cohorts[2].active_customers == 1 and cohorts[2].retention_pct == 50.0


def test_a_product_in_two_categories_counts_once(spark):
    links = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b")], "product_id long, category_id string")
    from tallyhouse.operators.dimensions import primary_categories

    assert {tuple(row) for row in primary_categories(links).collect()} == {(1, "a"), (2, "b")}


def test_slow_movers_include_unsold_products(spark):
    products = spark.createDataFrame(
        [(1, "a", True), (2, "b", True), (3, "c", False)], "product_id long, product_name string, is_active boolean"
    )
    mart = spark.createDataFrame(
        [(dt.date(2024, 5, 1), 1, 4, 40), (dt.date(2023, 5, 1), 2, 9, 90)],
        "order_date date, product_id long, units_sold long, gross_revenue_cents long",
    )
    rows = marts.slow_movers(products, mart, dt.date(2024, 5, 31)).collect()
    assert [(row.product_id, row.units_sold) for row in rows] == [(2, 0), (1, 4)]
    assert len(marts.slow_movers(products, mart, dt.date(2024, 5, 31), limit=1).collect()) == 1


def test_missing_stock_rows_are_counted(spark):
    stored = {(w, v) for w, v in product(range(11), range(20)) if (w * v) % 3 == 1}
    warehouses, variants = spark.range(11), spark.range(20)
    # A repeated row, and pairs with an unknown side, count for nothing.
    rows = [*sorted(stored), (1, 1), (99, 1), (1, 99)]
    levels = spark.createDataFrame(rows, "warehouse_id long, variant_id long")
    found = lookups.missing_stock_rows(warehouses, variants, levels).collect()
    assert len(found) == 31
    for row in found:
        at = 1 if row.side == "variant" else 0
        own = sum(pair[at] == int(row.id) for pair in stored)
        expected = 11 if row.side == "variant" else 20
        assert (row.expected_rows, row.present_rows) == (expected, own)
        assert row.missing_rows == expected - own
    empty = lookups.missing_stock_rows(warehouses.limit(0), variants, levels).collect()
    assert {(row.side, row.expected_rows) for row in empty} == {("variant", 0)}


def test_all_addresses_are_rows(spark):
    frame = spark.range(3000).selectExpr("if(id % 3 = 0, 1L, id) as customer_id", "id")
    rows = lookups.addresses_by_customer(frame).collect()
    assert sorted(row.address_id for row in rows) == list(range(3000))


def test_unknown_statuses_are_counted(spark):
    orders = spark.createDataFrame(
        [(dt.date(2024, 1, 1), status) for status in ("paid", "on_hold", None, "paid")],
        "order_date date, order_status string",
    )
    row = marts.orders_by_status_stacked(orders, ["pending", "paid"]).first()
    assert (row.pending, row.paid, row.other, row.order_count) == (0, 2, 2, 4)


def test_a_changed_sku_does_not_split_its_variant(spark):
    mart = spark.createDataFrame(
        [
            (dt.date(2024, 1, 1), 1, "old", 5, 50),
            (dt.date(2024, 1, 2), 1, "new", 5, 50),
            (dt.date(2024, 1, 2), 2, "b", 7, 70),
        ],
        "order_date date, variant_id long, sku string, units_sold long, gross_revenue_cents long",
    )
    span = resolve_range("2024-01-01", "2024-01-31")
    assert [tuple(row) for row in marts.top_skus(mart, span, 1).collect()] == [(1, "new", 10, 100)]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_samples_repeat_and_differ_by_seed(spark):
    frame = spark.range(1000)
    first = [row.id for row in lookups.random_rows(frame.repartition(3), "id", 50, 1).collect()]
    again = [row.id for row in lookups.random_rows(frame.repartition(7), "id", 50, 1).collect()]
    other = [row.id for row in lookups.random_rows(frame, "id", 50, 2).collect()]
    assert first == again != other and len(set(first)) == 50


def test_lines_without_a_payment_stay_candidates(spark):
    heads = spark.createDataFrame(
        [(1, 1, "paid"), (2, 1, "fulfilled"), (3, 1, "cancelled")], "id long, customer_id long, status string"
    ).withColumn("placed_at", F.lit(dt.datetime(2024, 1, 1)))
    lines = spark.createDataFrame([(10, 1, 1), (20, 2, 1), (30, 3, 1)], "id long, order_id long, quantity long")
    paid = spark.createDataFrame(
        [(5, 1, 100, "succeeded"), (6, 2, 100, "pending")], "id long, order_id long, amount_cents long, status string"
    )
    rows = {row.order_item_id: row.payment_id for row in lookups.refund_candidates(heads, lines, paid).collect()}
    assert rows == {10: 5, 20: None}


def test_slugs(spark):
    names = spark.createDataFrame([(1, "  Big & Bold -- Hat! "), (2, "--"), (3, "Ünder 9")], "id long, name string")
    found = {row.product_id: row.name_slug for row in lookups.product_slugs(names).collect()}
    assert found == {1: "big-bold-hat", 2: "", 3: "nder-9"}


def test_customers_without_orders_have_a_region(spark):
    d1 = dt.date(2024, 1, 1)
    frame = orders(spark, [(1, 1, d1, 10), (2, 1, d1, 5), (3, 9, d1, 7)])
    customers = spark.createDataFrame(
        [(1, "DE", "BE"), (2, "DE", "BE"), (3, "FR", None)],
        "customer_id long, default_country_code string, default_state string",
    )
    found = {tuple(row) for row in marts.geo_sales(frame, customers).collect()}
    assert found == {("DE", "BE", 2, 1, 2, 15), ("FR", None, 1, 0, 0, 0), (None, None, 1, 1, 1, 7)}


def test_unused_coupons_are_listed(spark):
    coupons = spark.createDataFrame([(1, "A", "fixed"), (2, "B", "fixed")], "id long, code string, discount_type string")
    used = spark.createDataFrame(
        [(1, 7, 5), (1, 8, 5), (1, 9, 5)], "coupon_id long, order_id long, discount_cents long"
    )
    # One order is unknown, one was cancelled.
    heads = spark.createDataFrame(
        [(7, 100, True), (9, 40, False)], "order_id long, total_cents long, is_revenue_order boolean"
    )
    rows = {row.coupon_code: row for row in marts.promo_performance(coupons, used, heads).collect()}
    assert (rows["A"].redemptions, rows["A"].influenced_gmv_cents) == (3, 100)
    assert (rows["B"].redemptions, rows["B"].discount_cents) == (0, 0)
