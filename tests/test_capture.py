"""Changed source rows through all layers, and the stream over two of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import changes
from checks.testbed import Testbed
from tallyhouse.plans import capture, refresh
from tallyhouse.plans.incremental import refresh_cart_months, refresh_changes, refresh_silver_months
from tallyhouse.plans.medallion import GOLD_MODELS, gold_over, silver_over
from tallyhouse.sources.warehouse import MONTH, Warehouse
from tallyhouse.streaming.maintenance import maintain_layers

FOLDER = "/root/testdata/sf0.001"
FACTS = ["fct_orders", "fct_order_items", "fct_payments", "fct_refunds"]
MARTS = ["mart_daily_sales", "mart_product_sales", "mart_customer_months"]
CUSTOMERS = ["mart_customer_cohorts", "mart_customer_ltv", "mart_orders_per_customer"]
SINCE = "placed_at >= '1997-10-01'"


class Cut:
    """Tables with a year of orders, lines of earlier ones and all else."""

    def __init__(self, source):
        self.source = source

    def table(self, name):
        frame = self.source.table(name)
        if name in ("carts", "product_reviews"):
            frame = frame.where("created_at >= '1997-10-01'")
        return frame.where(SINCE) if name == "orders" else frame


def same(left, right, *without):
    right = right.drop(*without)
    left = left.select(right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """All layers over the source before the changes, and the source behind them."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("lake")), "capture_")
    source = Cut(Testbed(spark, FOLDER))
    warehouse.create_databases()
    with warehouse.release() as release:
        first = changes.Before(source)
        refresh.refresh_bronze(release, first, ["products", "product_variants", "product_reviews"])
        capture.load(release, first)
        refresh.refresh_silver(release, ["dim_products", "dim_variants", *FACTS, "fct_carts", "fct_reviews"])
        refresh.refresh_gold(release, [*MARTS, "mart_funnel_daily", *CUSTOMERS])
    return warehouse, changes.After(source)


def test_a_month_reads_its_partitions_of_lines_payments_and_refunds(lake, spark):
    warehouse, _ = lake
    from tallyhouse.plans.incremental import _BronzeMonths

    layer = silver_over(_BronzeMonths(warehouse.layer("bronze"), [dt.date(1998, 1, 1)]))
    for fact, table in (("fct_order_items", "order_items"), ("fct_payments", "payments"), ("fct_refunds", "refunds")):
        plan = layer.table(fact)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if f"bronze_oltp__{table}__version" in line and "Scan" in line]
        assert scans and all("PartitionFilters: [_order_month" in s or "(_order_month#" in s for s in scans), fact


def test_rows_without_an_order_wait_for_it(lake):
    warehouse, source = lake
    waiting = warehouse.table("bronze", "order_items").where("_order_date is null")
    late = source.table("orders").where(changes.LATE).select(F.col("id").alias("order_id"))
    assert not late.isEmpty() and not waiting.join(late, "order_id", "left_semi").isEmpty()


def test_changes_reach_all_layers_at_once(lake, spark):
    warehouse, source = lake
    held = warehouse.snapshot()
    refresh_changes(warehouse, source, silver=FACTS, gold=MARTS, notes={"run": "1"})
    load = [*[c for c in MONTH if c.startswith("_")], *MONTH.values(), "_loaded_at", "_source_system"]
    for name in capture.ROUTES:
        assert same(source.table(name), warehouse.table("bronze", name), *load), name
    silver = silver_over(source)
    for name in [*FACTS, "fct_carts"]:
        assert same(silver.table(name), warehouse.table("silver", name), *MONTH.values()), name
    gold = gold_over(silver)
    for name in [*MARTS, "mart_funnel_daily", *CUSTOMERS]:
        assert same(gold.table(name), warehouse.table("gold", name), *MONTH.values()), name
    assert warehouse.note("run") == "1"
    # The snapshot from before still reads what was there before.
    assert held.table("silver", "fct_orders").count() < warehouse.table("silver", "fct_orders").count()
    # Nothing has changed since but what the overlap takes again.
    touched = capture.capture(warehouse, source)
    assert len(touched["_order_date"]) <= 24
    for name in ("orders", "order_items", "refunds"):
        assert same(source.table(name), warehouse.table("bronze", name), *load), name


def test_a_failed_refresh_takes_the_same_rows_again(lake, monkeypatch):
    warehouse, source = lake
    before = warehouse.state()
    monkeypatch.setitem(GOLD_MODELS, "mart_funnel_daily", None)
    with pytest.raises(AttributeError):
        refresh_changes(warehouse, source, silver=FACTS, gold=[])
    assert warehouse.state() == before


def test_an_order_taken_from_its_cart_frees_it(lake, spark):
    """The cart's month is another than the order's, and only that is in the changes."""
    warehouse, source = lake
    first = warehouse.table("silver", "fct_orders").where("cart_id is not null").orderBy("order_id").first()
    month = first.order_date.replace(day=1)
    bronze = warehouse.layer("bronze")

    class Changed:
        def table(self, name):
            frame = bronze.table(name)
            if name == "orders":
                kept = F.when(F.col("id") != first.order_id, F.col("cart_id"))
                return frame.withColumn("cart_id", kept)
            if name == "carts":  # another month than the order's, and not among the changed
                early = F.expr(f"if(id = {first.cart_id}, timestamp '1997-02-03', created_at)")
                return frame.withColumn("created_at", early).drop("_cart_date", "_cart_month")
            return frame.drop("_cart_date", "_cart_month")

    with warehouse.release() as release:
        refresh_silver_months(release, Changed(), [month], ["fct_orders"])
        months = refresh_cart_months(release, Changed(), [], [month])
        freed = release.table("silver", "fct_carts").where(f"cart_date = '1997-02-03'").collect()
        release.staged.clear()  # not kept
    assert dt.date(1997, 2, 1) in months
    assert [(r.cart_id, r.is_converted) for r in freed if r.cart_id == first.cart_id] == [(first.cart_id, False)]


def test_stream_repeats_a_half_done_batch_and_skips_a_done_one(lake, spark, given, tmp_path, monkeypatch):
    warehouse, source = lake
    bronze = warehouse.layer("bronze")
    gone = warehouse.table("silver", "fct_orders").where("is_revenue_order").orderBy("order_id").first()
    needed = ["orders", "order_items", "product_variants", "products", "payments", "refunds", "product_reviews"]
    frames = {name: bronze.table(name) for name in needed}
    frames["orders"] = frames["orders"].where(f"id <> {gone.order_id}")
    now = given(**frames)
    facts = [*FACTS, "fct_reviews"]
    names = ["mart_daily_sales", "mart_product_sales"]
    spark.createDataFrame([(gone.order_date,)], "order_date date").write.parquet(str(tmp_path / "changes"))
    rows = spark.readStream.schema("order_date date").parquet(str(tmp_path / "changes"))

    def run():
        query = maintain_layers(rows, warehouse, lambda: now, str(tmp_path / "progress"), facts, names)
        query.awaitTermination(300)

    before = warehouse.state()
    with monkeypatch.context() as broken:  # ends between the layers
        broken.setitem(GOLD_MODELS, "mart_daily_sales", None)
        with pytest.raises(Exception):
            run()
    assert warehouse.state() == before
    run()
    made = warehouse.state()
    assert made["note", "batch of orders"] == "0"
    silver = silver_over(now)
    for name in facts:
        assert same(silver.table(name), warehouse.table("silver", name), *MONTH.values()), name
    gold = gold_over(silver)
    for name in names:
        assert same(gold.table(name), warehouse.table("gold", name), *MONTH.values()), name
    # The stream dies before it can say that the batch was done, and gets it again.
    import shutil

    shutil.rmtree(tmp_path / "progress" / "commits")
    run()
    assert warehouse.state() == made
