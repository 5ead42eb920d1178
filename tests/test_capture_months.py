"""A captured change rewrites the months of the tables it reaches, and no others."""

import datetime as dt

import pytest

from tallyhouse.plans import capture
from tallyhouse.plans.incremental import refresh_changes
from tallyhouse.sources.warehouse import MONTH, Warehouse

NAMES = ["orders", "order_items", "payments", "refunds"]
SCHEMAS = {
    "orders": "id long, placed_at timestamp, updated_at timestamp",
    "order_items": "id string, order_id long",
    "payments": "id long, order_id long, created_at timestamp, paid_at timestamp",
    "refunds": "id string, payment_id long, created_at timestamp, refunded_at timestamp",
}
JANUARY, MARCH, MAY = (dt.date(2001, month, 1) for month in (1, 3, 5))


def at(month, day=5):
    return dt.datetime(2001, month, day)


def tables(spark, given, copies=1, moved=False, refunded=False):
    """Orders of January and March; order 2 moves to May, order 1 is refunded later."""
    second = (2, at(5), at(12)) if moved else (2, at(3), at(3))
    rows = {
        "orders": [(1, at(1), at(1)), second, (None, at(1), at(1))],
        "order_items": [("a", 1), ("b", 2), ("c", 2), ("d", 9), (None, None)],
        "payments": [(1, 1, at(1), None), (2, 2, at(3), at(3, 6)), (3, None, at(3), None)],
        "refunds": [("r", 2, at(3), None)] + [("s", 1, at(11), None)] * refunded,
    }
    return given(**{name: spark.createDataFrame(rows[name] * copies, schema) for name, schema in SCHEMAS.items()})


def content(frame):
    return sorted(map(str, frame.drop("_loaded_at", *MONTH.values()).collect()))


@pytest.fixture
def lake(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path), f"months_{tmp_path.name.replace('-', '_')}_")
    made.create_databases()
    return made


def test_a_refund_alone_rewrites_refunds_alone(spark, given, lake):
    capture.load(lake, tables(spark, given), NAMES)
    before = {name: lake.current("bronze", name) for name in NAMES}
    months = capture.capture_tables(lake, tables(spark, given, refunded=True), dt.timedelta(0), NAMES)
    assert months["refunds"] >= {JANUARY} and not months["orders"] - {MARCH}
    lines = lake.table("bronze", "order_items").where("order_id = 1")
    assert all(before["order_items"].rsplit("_", 1)[1] in row[0] for row in lines.selectExpr("input_file_name()").collect())
    refund = lake.table("bronze", "refunds").where("id = 's'").first()
    assert refund["_order_date"] == dt.date(2001, 1, 5)


@pytest.mark.parametrize("copies", [1, 2])
def test_rows_follow_an_order_that_moved(spark, given, lake, copies):
    """Repeated rows too are where all months written anew would have them."""
    capture.load(lake, tables(spark, given, copies), NAMES)
    later = tables(spark, given, copies, moved=True, refunded=copies > 1)
    months = capture.capture_tables(lake, later, dt.timedelta(0), NAMES)
    assert all(months[name] >= {MARCH, MAY} for name in NAMES)
    if copies == 1:
        kept = {name: content(lake.table("bronze", name)) for name in NAMES}
        capture.load(lake, tables(spark, given, moved=True), NAMES)
        assert kept == {name: content(lake.table("bronze", name)) for name in NAMES}
    else:
        # Months where a parent's id repeats are written below it, as before.
        assert all(JANUARY in months[name] for name in ("order_items", "payments", "refunds"))


def test_facts_and_marts_take_the_months_of_what_they_read(spark, given, lake, monkeypatch):
    from tallyhouse.plans import incremental

    asked = {}
    found = {"orders": {MARCH}, "order_items": {MARCH}, "payments": {MARCH}, "refunds": {JANUARY, MARCH}, "carts": set()}
    monkeypatch.setattr(incremental, "capture_tables", lambda *_, **__: found)
    monkeypatch.setattr(incremental, "refresh_cart_months", lambda *_: [])
    monkeypatch.setattr(incremental, "refresh_customers", lambda *_: None)

    def note(_, __, months, names, date=""):
        asked.update({name: set(months) for name in names})

    monkeypatch.setattr(incremental, "refresh_silver_months", note)
    monkeypatch.setattr(incremental, "refresh_months", note)
    refresh_changes(lake, None, gold=["mart_orders_by_status", "mart_product_sales"])
    assert asked["fct_order_items"] == asked["fct_orders"] == asked["mart_orders_by_status"] == {MARCH}
    assert asked["fct_refunds"] == asked["mart_product_sales"] == {JANUARY, MARCH}
