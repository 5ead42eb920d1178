"""Many rows are refreshed a run of months at a time."""

import datetime as dt

import pytest

from tallyhouse.plans import incremental
from tallyhouse.plans.incremental import month_runs, refresh_months, refresh_silver_months
from tallyhouse.sources.warehouse import Release, Warehouse

JAN, FEB, MAR = (dt.date(2024, month, 1) for month in (1, 2, 3))


@pytest.fixture
def written(spark, tmp_path):
    """Bronze orders, their facts and two marts of three months with 3, 1 and 2 orders."""
    warehouse = Warehouse(spark, str(tmp_path), "runs_")
    warehouse.create_databases()
    orders = spark.sql("""
        select id, concat('O', id) as order_number, id % 2 as customer_id, id as cart_id, 'paid' as status,
            'usd' as currency_code, 5L as subtotal_cents, 0L as discount_cents, 0L as shipping_cents,
            0L as tax_cents, id as total_cents, 1L as shipping_address_id, 1L as billing_address_id,
            timestamp(placed) as placed_at, timestamp(placed) as created_at, timestamp(placed) as updated_at,
            date(placed) as _order_date
        from values (1L, '2024-01-01'), (2L, '2024-01-09'), (3L, '2024-01-31'), (4L, '2024-02-29'),
            (5L, '2024-03-01'), (6L, '2024-03-01') as o(id, placed)
    """)
    warehouse.replace("bronze", "orders", orders, "_order_date")
    refresh_all(warehouse)
    return warehouse


def refresh_all(warehouse):
    facts = incremental.silver_over(warehouse.layer("bronze")).build("fct_orders")
    warehouse.replace("silver", "fct_orders", facts, "order_date")
    model = incremental.GOLD_MODELS["mart_customer_months"]
    made = model.make(warehouse.table("silver", "fct_orders"))
    warehouse.replace("gold", "mart_customer_months", made, "order_date")


def rows(warehouse, layer, name):
    return sorted(map(tuple, warehouse.table(layer, name).collect()), key=repr)


def test_runs_end_at_the_rows_and_never_split_a_month(written, monkeypatch):
    table, months = written.table("bronze", "orders"), [JAN, FEB, MAR]
    assert month_runs(months, [table]) == [months]
    monkeypatch.setattr(incremental, "WRITES", 100)
    for most, runs in ((1, [[JAN], [FEB], [MAR]]), (3, [[JAN], [FEB, MAR]]), (4, [[JAN, FEB], [MAR]])):
        monkeypatch.setattr(incremental, "ROWS_A_WRITE", most)
        assert month_runs(months, [table]) == runs
    assert month_runs(months, [table.drop("_order_month")]) == [months]
    assert month_runs([], []) == [[]]


def test_runs_write_the_rows_of_one_refresh(written, monkeypatch):
    wrote = []
    replace = Release.replace_months

    def spied(self, layer, name, frame, month_of, months):
        wrote.append((name, list(months)))
        return replace(self, layer, name, frame, month_of, months)

    facts, mart = (rows(written, *table) for table in (("silver", "fct_orders"), ("gold", "mart_customer_months")))
    monkeypatch.setattr(Release, "replace_months", spied)
    monkeypatch.setattr(incremental, "WRITES", 100)
    monkeypatch.setattr(incremental, "ROWS_A_WRITE", 3)
    months = [MAR, JAN, FEB]
    refresh_silver_months(written, written.layer("bronze"), months, ["fct_orders"])
    refresh_months(written, written.layer("silver"), months, ["mart_customer_months"])
    runs = [[JAN], [FEB, MAR]]
    assert wrote == [(name, run) for name in ("fct_orders", "mart_customer_months") for run in runs]
    assert rows(written, "silver", "fct_orders") == facts
    assert rows(written, "gold", "mart_customer_months") == mart
