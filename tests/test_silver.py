"""Hand-made rows for the cases the test files cannot show."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators import categories, dimensions, facts
from tallyhouse.plans.medallion import silver_over

ADDRESS = (
    "id long, customer_id long, city string, state string, postal_code string,"
    " country_code string, is_default_shipping boolean, updated_at timestamp"
)
CUSTOMER = (
    "id long, user_id long, first_name string, last_name string, phone string,"
    " date_of_birth date, marketing_opt_in boolean, lifetime_value_cache decimal(12,2),"
    " created_at timestamp, updated_at timestamp"
)
ORDER = (
    "id long, order_number string, customer_id long, cart_id long, status string,"
    " currency_code string, subtotal_cents long, discount_cents long, shipping_cents long,"
    " tax_cents long, total_cents long, shipping_address_id long, billing_address_id long,"
    " placed_at timestamp, created_at timestamp, updated_at timestamp"
)
NOON = dt.datetime(2024, 3, 5, 12)


def order(key, status="paid", total=100, customer=1, placed=NOON, cart=None):
    return (
        key, f"N{key}", customer, cart, status, "usd", total, 0, 0, 0, total, None, None,
        placed, placed, placed,
    )


def test_latest_default_address_then_lowest_id(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    rows = [
        (1, 7, "old", "s", "p", "c", True, old),
        (3, 7, "tie-high", "s", "p", "c", True, new),
        (2, 7, "tie-low", "s", "p", "c", True, new),
        (4, 7, "not default", "s", "p", "c", False, dt.datetime(2025, 1, 1)),
        (5, 8, "undated", "s", "p", "c", True, None),
        (6, 8, "dated", "s", "p", "c", True, old),
    ]
    found = dimensions.latest_default_addresses(spark.createDataFrame(rows, ADDRESS))
    assert {row.customer_id: row.default_city for row in found.collect()} == {
        7: "tie-low",
        8: "dated",
    }


def test_address_choice_limits_rows_before_the_shuffle(spark):
    frame = spark.createDataFrame([], ADDRESS)
    plan = dimensions.latest_default_addresses(frame)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_names_and_opt_in(spark):
    def customer(key, first, last, opt_in):
        return (key, None, first, last, None, None, opt_in, None, NOON, NOON)

    rows = [
        customer(1, "  ", "  ", None),
        customer(2, " Ann ", "  ", True),
        customer(3, None, "Lee", False),
    ]
    found = dimensions.customers(
        spark.createDataFrame(rows, CUSTOMER), spark.createDataFrame([], ADDRESS)
    )
    by_id = {row.customer_id: row for row in found.collect()}
    assert by_id[1].full_name is None and by_id[1].marketing_opt_in is False
    assert by_id[2].full_name == "Ann "
    assert by_id[3].full_name is None
    assert by_id[1].default_city is None


def test_calendar(spark):
    days = [dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 2)]
    found = dimensions.dates(spark.createDataFrame([(day,) for day in days], "placed_at timestamp"))
    rows = {row.date_day: row for row in found.collect()}
    assert sorted(rows) == [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    sunday = rows[dt.date(2023, 12, 31)]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sunday", True)
    assert (sunday.year_month, sunday.year_quarter) == ("2023-12", "2023-Q4")
    assert dimensions.dates(spark.createDataFrame([], "placed_at timestamp")).count() == 0


def test_margin_of_a_free_variant_is_null(spark):
    columns = (
        "id long, product_id long, sku string, name string, attributes string, price_cents long,"
        " compare_at_price_cents long, cost_cents long, weight_grams long, is_active boolean,"
        " created_at timestamp, updated_at timestamp"
    )
    rows = [
        (1, 1, " a ", "n", "{}", 0, None, None, None, None, NOON, NOON),
        (2, 1, "b", "n", "{}", 200, None, 50, None, True, NOON, NOON),
        (3, 9, "orphan", "n", "{}", 200, None, 50, None, True, NOON, NOON),
    ]
    parents = spark.createDataFrame(
        [(1, "P", "active")], "product_id long, product_name string, product_status string"
    )
    found = {
        row.variant_id: row
        for row in dimensions.variants(spark.createDataFrame(rows, columns), parents).collect()
    }
    assert set(found) == {1, 2}
    assert found[1].list_margin_pct is None and found[1].cost_cents == 0
    assert found[1].sku == "A" and found[1].is_active is False
    assert found[2].list_margin_pct == 0.75


def test_order_filter_and_raw_status_flags(spark):
    rows = [
        order(1),
        order(2, " Paid"),
        order(3, total=-1),
        order(4, customer=None),
        order(5, placed=None),
        order(6, "cancelled"),
    ]
    found = {r.order_id: r for r in facts.orders(spark.createDataFrame(rows, ORDER)).collect()}
    assert set(found) == {1, 2, 6}
    assert found[2].order_status == "paid" and found[2].is_revenue_order is False
    assert found[6].is_cancelled and not found[6].is_revenue_order


def test_lead_times_count_hour_boundaries(spark):
    orders = facts.orders(
        spark.createDataFrame([order(1, placed=dt.datetime(2024, 1, 1, 10, 59))], ORDER)
    )
    columns = (
        "id long, order_id long, shipping_method_id long, warehouse_id long,"
        " tracking_number string, status string, shipped_at timestamp, delivered_at timestamp,"
        " created_at timestamp"
    )
    rows = [
        (1, 1, 1, 1, "t", "delivered", dt.datetime(2024, 1, 1, 11, 1), dt.datetime(2024, 1, 1, 9), NOON),
        (2, 1, 1, 1, "t", "delivered", None, dt.datetime(2024, 1, 1, 12), NOON),
    ]
    found = facts.shipments(spark.createDataFrame(rows, columns), orders)
    by_id = {row.shipment_id: row for row in found.collect()}
    assert by_id[1].hours_order_to_ship == 1
    assert by_id[1].hours_ship_to_deliver == -2 and by_id[1].hours_order_to_deliver == -1
    assert by_id[2].hours_order_to_ship is None and by_id[2].hours_ship_to_deliver is None
    assert by_id[2].hours_order_to_deliver == 2


def test_carts_without_order_are_abandoned(spark):
    orders = facts.orders(spark.createDataFrame([order(1, cart=10)], ORDER))
    carts = spark.createDataFrame(
        [(10, 1, "converted", "usd", NOON, NOON), (11, 1, "active", "usd", NOON, NOON)],
        "id long, customer_id long, status string, currency_code string,"
        " created_at timestamp, updated_at timestamp",
    )
    items = spark.createDataFrame(
        [(10, 2, 100), (10, 1, 50)], "cart_id long, quantity long, unit_price_cents long"
    )
    found = {row.cart_id: row for row in facts.carts(carts, items, orders).collect()}
    assert (found[10].item_quantity, found[10].cart_value_cents) == (3, 250)
    assert found[10].is_converted and not found[10].is_abandoned
    assert (found[11].item_quantity, found[11].cart_value_cents) == (0, 0)
    assert found[11].is_abandoned


def test_reviews_and_stock_filters(spark):
    reviews = spark.createDataFrame(
        [(key, 1, 1, None, key, " ", None, None, NOON) for key in range(7)],
        "id long, product_id long, customer_id long, order_id long, rating int, title string,"
        " body string, is_verified_purchase boolean, created_at timestamp",
    )
    found = facts.reviews(reviews).collect()
    assert sorted(row.rating for row in found) == [1, 2, 3, 4, 5]
    assert all(row.review_title is None and not row.is_verified_purchase for row in found)

    stock = spark.createDataFrame(
        [(1, 1, 5, 8, None), (1, 2, -1, 0, 3), (1, 3, 4, 0, 4), (1, 4, 0, 0, None)],
        "warehouse_id long, variant_id long, quantity_on_hand long, quantity_reserved long,"
        " reorder_point long",
    ).withColumn("updated_at", F.lit(NOON))
    by_variant = {row.variant_id: row for row in facts.inventory(stock).collect()}
    assert set(by_variant) == {1, 3, 4}
    assert by_variant[1].quantity_available == 0 and by_variant[1].is_stockout
    assert not by_variant[1].is_below_reorder_point
    assert by_variant[3].is_below_reorder_point and not by_variant[3].is_stockout
    assert by_variant[4].is_below_reorder_point and by_variant[4].is_stockout


def test_category_paths_of_a_deep_tree(spark):
    rows = [(1, None, "a", "a"), (2, 1, "b", "b"), (3, 2, "c", "c"), (4, 3, "d", "d")]
    tree = spark.createDataFrame(
        rows, "category_id long, parent_id long, category_name string, category_slug string"
    )
    found = {row.category_id: row for row in categories.category_paths(tree).collect()}
    assert found[4].name_path == "a > b > c > d" and found[4].depth == 3 and found[4].root_id == 1


def test_category_paths_with_unknown_parents_and_cycles(spark):
    rows = [(1, 99, "a", "a"), (2, 1, "b", "b"), (3, 4, "c", "c"), (4, 3, "d", "d"), (5, 4, "e", "e")]
    tree = spark.createDataFrame(
        rows, "category_id long, parent_id long, category_name string, category_slug string"
    )
    found = {row.category_id: row for row in categories.category_paths(tree).collect()}
    assert set(found) == {1, 2} and found[2].name_path == "a > b" and found[2].root_id == 1
    lost = categories.categories_without_root(tree).collect()
    assert {row.category_id for row in lost} == {3, 4, 5}


def test_a_layer_builds_on_what_is_written(spark, given):
    layer = silver_over(given(orders=spark.createDataFrame([order(1), order(2)], ORDER)))
    assert layer.table("fct_orders").count() == 2
    layer.use_written("fct_orders", layer.table("fct_orders").where("order_id = 1"))
    assert layer.table("fct_orders").count() == 1
