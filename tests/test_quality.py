from pyspark.sql import functions as F

from tallyhouse.operators import quality


def one(frame):
    row = frame.collect()[0]
    return row.failures, row.status


def test_unique(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 3), (2, 4), (None, 5), (None, 5)], "a long, b long")
    assert one(quality.unique(frame, "t", "a")) == (2, "error")
    assert one(quality.unique(frame, "t", "a", "b")) == (1, "error")
    assert one(quality.unique(frame.limit(0), "t", "a")) == (0, "pass")


def test_not_null(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, 3)], "a long, b long")
    found = {row.column_name: (row.failures, row.status) for row in quality.not_null(frame, "t", "a", "b").collect()}
    assert found == {"a": (1, "error"), "b": (2, "error")}


def test_relationships_count_child_rows(spark):
    child = spark.createDataFrame([(1,)] * 5 + [(9,)] * 3 + [(None,)], "fk long")
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert one(quality.relationships(child, "t", "fk", parent, "id")) == (3, "error")
    assert one(quality.relationships(child.where("fk = 1"), "t", "fk", parent, "id")) == (0, "pass")


def test_unknown_payment_status_warns(spark):
    frame = spark.createDataFrame([("succeeded",), ("odd",), ("odd",), ("odder",), (None,)], "s string")
    check = quality.accepted_values(frame, "payments", "s", ["succeeded"], quality.WARN)
    assert one(check) == (2, "warn")


def test_rules_and_dropped_rows(spark):
    frame = spark.createDataFrame([(0,), (5,), (None,)], "rating int")
    in_range = F.col("rating").between(1, 5)
    assert one(quality.holds(frame, "t", "rating", "range", in_range)) == (1, "error")
    assert one(quality.dropped(frame, "t", "range", in_range)) == (2, "warn")


def test_arithmetic_audits(spark):
    orders = spark.createDataFrame(
        [(1, 100, 10, 5, 7, 102), (2, 10, 50, 0, 0, 0), (3, 100, 0, 0, 0, 99)],
        "id long, subtotal_cents long, discount_cents long, shipping_cents long, tax_cents long, total_cents long",
    )
    assert [row.order_id for row in quality.order_total_mismatches(orders).collect()] == [3]
    payments = spark.createDataFrame([(1, 1, 102), (2, 3, 100)], "id long, order_id long, amount_cents long")
    assert [row.payment_id for row in quality.payment_mismatches(payments, orders).collect()] == [2]
    coupons = spark.createDataFrame(
        [(1, "P", "percent", 10), (2, "F", "fixed", 500)],
        "id long, code string, discount_type string, discount_value long",
    )
    redemptions = spark.createDataFrame(
        [(1, 1, 1, 10), (2, 2, 1, 100), (3, 2, 2, 10), (4, 1, 3, 11)],
        "id long, coupon_id long, order_id long, discount_cents long",
    )
    found = quality.coupon_mismatches(redemptions, coupons, orders).collect()
    assert [row.redemption_id for row in found] == [4]
