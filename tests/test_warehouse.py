"""Written layers, month refresh, the stream, and source options."""

import datetime as dt
import json

import pytest

from tallyhouse.operators import analytics
from tallyhouse.operators.bronze import mirror
from tallyhouse.plans import refresh
from tallyhouse.plans.incremental import refresh_months, refresh_silver_months, touched_months
from tallyhouse.plans.medallion import SILVER_MODELS, silver_over
from tallyhouse.sources.access import json_rows, query_with_parameters
from tallyhouse.sources.oltp import FileSource, JdbcSource, Split, UuidSplit, typed
from tallyhouse.sources.schemas import BRONZE_SCHEMAS, BRONZE_TABLES, with_keys_as
from checks.testbed import Testbed
from tallyhouse.sources.warehouse import Warehouse
from tallyhouse.streaming.maintenance import maintain_gold

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    """All layers written once, under their plain names."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("lake")), "pipeline_")
    refresh.refresh_all(warehouse, Testbed(spark, FOLDER))
    return warehouse


def test_all_layers_are_written(pipeline, spark):
    for layer, count in (("bronze", 23), ("silver", 21), ("gold", 25)):
        tables = spark.catalog.listTables(pipeline.database(layer))
        # In gold, the state is one of the views.
        assert len([table for table in tables if table.tableType == "VIEW"]) == count
    assert pipeline.full_name("gold", "mart_product_sales").endswith("gold.gold_mart_product_sales")
    orders = pipeline.table("bronze", "orders")
    assert orders.columns[-2:] == ["_loaded_at", "_source_system"]
    assert orders.count() == 1500


def test_written_equals_lazy(pipeline, spark):
    lazy = silver_over(Testbed(spark, FOLDER)).table("fct_order_items")
    written = pipeline.table("silver", "fct_order_items").select(lazy.columns)
    assert written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0


def test_range_prunes_months_and_reaches_the_scan(pipeline):
    span = analytics.resolve_range("1998-01-01", "1998-03-01")
    days = analytics.product_days(pipeline.table("gold", "mart_product_sales"), span)
    plan = days.select("gross_revenue_cents")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "GreaterThanOrEqual(order_date" in plan
    assert "ReadSchema: struct<order_date:date,gross_revenue_cents:bigint>" in plan


def test_months_are_replaced_and_emptied(pipeline, spark, given):
    warehouse = Warehouse(spark, pipeline.root, "months_")
    warehouse.create_databases()
    silver = pipeline.layer("silver")
    names = ["fct_orders", "fct_order_items", "fct_refunds", "fct_reviews"]
    frames = {name: silver.table(name) for name in names}
    january, february = dt.date(1998, 1, 1), dt.date(1998, 2, 1)
    for name in ("mart_daily_sales", "mart_product_sales"):
        old = pipeline.table("gold", name).drop("order_month")
        warehouse.replace("gold", name, old, "order_date")

    # January loses all its orders, February all but its first ten days.
    def cut(frame):
        return frame.where("not (order_date between '1998-01-01' and '1998-01-31')").where(
            "not (order_date between '1998-02-11' and '1998-02-28')"
        )

    changed = given(
        **{k: cut(v) if k != "fct_reviews" else v for k, v in frames.items()}
    )
    refresh_months(warehouse, changed, [january, february], ["mart_daily_sales", "mart_product_sales"])
    for name in ("mart_daily_sales", "mart_product_sales"):
        before = pipeline.table("gold", name)
        after = warehouse.table("gold", name)
        untouched = "order_month not in (date '1998-01-01', date '1998-02-01')"
        assert after.where(untouched).exceptAll(before.where(untouched)).count() == 0
        assert after.where(untouched).count() == before.where(untouched).count()
        days = [row.order_date for row in after.where("not (" + untouched + ")").collect()]
        assert days and max(days) <= dt.date(1998, 2, 10) and min(days) >= february


def test_readers_see_old_or_new_rows(spark, tmp_path, monkeypatch):
    """The table is read before each statement of a refresh, and by a failed one."""
    warehouse = Warehouse(spark, str(tmp_path), "switch_")
    warehouse.create_databases()
    january, march = dt.date(2024, 1, 1), dt.date(2024, 3, 1)

    def rows(value, *days):
        return spark.createDataFrame([(day, value) for day in days], "order_date date, value int")

    def seen():
        return sorted(tuple(r) for r in warehouse.table("gold", "m").select("order_date", "value").collect())

    class Watched:
        """The session, reading the table before each statement."""

        def __init__(self):
            self.states = []

        def sql(self, text):
            self.states.append(seen_before())
            if self.fail and text.startswith(self.fail):
                raise RuntimeError(text)
            return spark.sql(text)

        fail = None

        def __getattr__(self, name):
            return getattr(spark, name)

    def seen_before():
        return sorted(
            tuple(r) for r in spark.table(warehouse.full_name("gold", "m")).select("order_date", "value").collect()
        )

    warehouse.replace("gold", "m", rows(1, january, march), "order_date")
    old, first = seen(), warehouse.current("gold", "m")
    watched = Watched()
    monkeypatch.setattr(warehouse, "spark", watched)
    watched.fail = "create or replace view"
    with pytest.raises(RuntimeError):
        warehouse.replace("gold", "m", rows(2, january, march), "order_date")
    assert seen() == old
    watched.fail = None
    warehouse.replace("gold", "m", rows(2, january, march), "order_date")
    new = [(january, 2), (march, 2)]
    assert seen() == new and all(state in (old, new) for state in watched.states)

    # One month gets other rows, one a first row, one stays.
    watched.states.clear()
    february = dt.date(2024, 2, 1)
    warehouse.replace_months("gold", "m", rows(3, january, february), "order_date", [january, february])
    newer = [(january, 3), (february, 3), (march, 2)]
    assert seen() == newer and all(state in (new, newer) for state in watched.states)

    # The second version's folder still holds March.
    folders = warehouse.expire("gold", "m")
    assert len(folders) == 2 and any(first.endswith(folder.rsplit("/", 1)[1]) for folder in folders)
    assert seen() == newer and warehouse.expire("gold", "m") == []

    # One month loses its rows, then nothing needs the second version.
    warehouse.replace_months("gold", "m", rows(4), "order_date", [march])
    assert seen() == newer[:2] and len(warehouse.expire("gold", "m")) == 1
    assert seen() == newer[:2]


def test_a_release_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Snapshots taken before every statement of a release never mix its tables."""
    warehouse = Warehouse(spark, str(tmp_path), "whole_")
    warehouse.create_databases()
    january, march = dt.date(2024, 1, 1), dt.date(2024, 3, 1)

    def rows(value):
        return spark.createDataFrame([(january, value), (march, value)], "order_date date, value int")

    def write(release, value):
        release.replace("silver", "a", rows(value))
        release.replace("silver", "b", rows(value), "order_date")
        release.replace_months("gold", "c", rows(value), "order_date", [january, march])
        assert release.table("silver", "a").first().value == value
        release.note("batch", str(value))

    warehouse.replace("gold", "c", rows(0), "order_date")
    with warehouse.release() as release:
        write(release, 1)
    held = warehouse.snapshot()

    def values(snapshot):
        frames = [snapshot.table(*key) for key in (("silver", "a"), ("silver", "b"), ("gold", "c"))]
        return {row.value for frame in frames for row in frame.select("value").collect()} | {int(snapshot.state["note", "batch"])}

    seen, plain = [], spark.sql

    class Watched:
        fail = None

        def sql(self, text):
            seen.append(values(Warehouse(spark, warehouse.root, "whole_").snapshot()))
            if self.fail and self.fail in text:
                raise RuntimeError(text)
            return plain(text)

        def __getattr__(self, name):
            return getattr(spark, name)

    watched = Watched()
    monkeypatch.setattr(warehouse, "spark", watched)
    for fail in ("create table", "alter table", "warehouse_state"):
        watched.fail = fail
        with pytest.raises(RuntimeError), warehouse.release() as release:
            write(release, 2)
        assert values(warehouse.snapshot()) == {1}
    watched.fail = None
    with warehouse.release() as release:
        write(release, 3)
    assert {1} in seen and {3} in seen and all(state in ({1}, {3}) for state in seen)
    assert values(held) == {1} and values(warehouse.snapshot()) == {3} and warehouse.note("batch") == "3"


def test_fact_months_follow_the_source(pipeline, spark, given):
    """One order leaves the source, another month is not touched."""
    warehouse = Warehouse(spark, pipeline.root, "facts_")
    warehouse.create_databases()
    bronze, names = pipeline.layer("bronze"), ["fct_orders", "fct_order_items", "fct_reviews"]
    for name in names:
        model = SILVER_MODELS[name]
        old = pipeline.table("silver", name).drop("order_month", "review_month")
        warehouse.replace("silver", name, old, model.month_of)
    january = pipeline.table("silver", "fct_orders").where("order_month = date '1998-01-01'")
    gone = january.orderBy("order_id").first().order_id
    needed = ["orders", "order_items", "product_variants", "products", "product_reviews"]
    frames = {name: bronze.table(name) for name in needed}
    frames["orders"] = frames["orders"].where(f"id <> {gone}")
    refresh_silver_months(warehouse, given(**frames), [dt.date(1998, 1, 20)], names)
    for name in names:
        before, after = pipeline.table("silver", name), warehouse.table("silver", name)
        if name != "fct_reviews":
            before = before.where(f"order_id <> {gone}")
        columns = before.columns
        assert before.exceptAll(after.select(columns)).count() == 0, name
        assert after.count() == before.count()
    with pytest.raises(ValueError):
        refresh_silver_months(warehouse, bronze, [dt.date(1998, 1, 1)], ["fct_carts"])


def test_months_of_a_mart_made_from_a_mart(pipeline, spark):
    """Brands of a month follow the product mart's written month."""
    warehouse = Warehouse(spark, pipeline.root, "beside_")
    warehouse.create_databases()
    names = ["mart_product_sales", "mart_brand_sales", "mart_variant_sales"]
    for name in names:
        old = pipeline.table("gold", name).where("order_month <> '1998-02-01'")
        warehouse.replace("gold", name, old.drop("order_month"), "order_date")
    refresh_months(warehouse, pipeline.layer("silver"), [dt.date(1998, 2, 1)], names)
    for name in names:
        whole = pipeline.table("gold", name)
        again = warehouse.table("gold", name).select(whole.columns)
        assert whole.exceptAll(again).count() == 0 and again.exceptAll(whole).count() == 0, name
    with pytest.raises(ValueError):
        refresh_months(warehouse, pipeline.layer("silver"), [dt.date(1998, 2, 1)], ["mart_customer_ltv"])


def test_only_month_tables_can_be_refreshed_by_month(pipeline, monkeypatch):
    from tallyhouse.plans import incremental
    from tallyhouse.plans.medallion import Model

    monkeypatch.setitem(incremental.GOLD_MODELS, "flat", Model(lambda: None))
    with pytest.raises(ValueError):
        refresh_months(pipeline, pipeline.layer("silver"), [dt.date(1998, 1, 1)], ["flat"])


def test_stream_of_changes_updates_old_months(pipeline, spark, given, tmp_path):
    """A late refund of an old order changes the mart day of that order."""
    warehouse = Warehouse(spark, pipeline.root, "stream_")
    warehouse.create_databases()
    for name in ("mart_daily_sales", "mart_product_sales"):
        old = pipeline.table("gold", name).drop("order_month")
        warehouse.replace("gold", name, old, "order_date")
    silver = pipeline.layer("silver")
    refunds = silver.table("fct_refunds")
    sale = silver.table("fct_orders").where("is_revenue_order").orderBy("placed_at").first()
    late = refunds.limit(1).selectExpr(
        *[
            {
                "order_id": f"{sale.order_id}L as order_id",
                "order_date": f"date '{sale.order_date}' as order_date",
                "order_month": f"date '{sale.order_date.replace(day=1)}' as order_month",
                "refund_cents": "77L as refund_cents",
                "is_completed": "true as is_completed",
            }.get(column, column)
            for column in refunds.columns
        ]
    )
    now = given(
        fct_refunds=refunds.unionByName(late),
        **{n: silver.table(n) for n in ("fct_orders", "fct_order_items", "fct_reviews")},
    )
    late.select("order_date").write.parquet(str(tmp_path / "changes"))
    changes = spark.readStream.schema("order_date date").parquet(str(tmp_path / "changes"))
    for _ in range(2):  # nothing is left for the second run
        query = maintain_gold(changes, warehouse, lambda: now, str(tmp_path / "progress"))
        query.awaitTermination(120)
    total = "sum(refund_cents)"
    before = pipeline.table("gold", "mart_daily_sales").agg({"refund_cents": "sum"}).first()[total]
    after = warehouse.table("gold", "mart_daily_sales").agg({"refund_cents": "sum"}).first()[total]
    assert after == before + 77


def test_touched_months(spark):
    rows = [(dt.date(2024, 1, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 3, 2),), (None,)]
    months = touched_months(spark.createDataFrame(rows, "order_date date"))
    assert sorted(months) == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]


def test_unknown_layer(spark):
    with pytest.raises(ValueError):
        Warehouse(spark, "/tmp/nowhere").database("platinum")


def test_parameters_keep_their_types(spark):
    row = query_with_parameters(
        spark, "select ? as a, ? as b, ? as c, ? as d, ? as e", ["x", 1, 2**40, 0.5, None]
    )
    assert [kind for _, kind in row.dtypes] == ["string", "int", "bigint", "double", "void"]
    assert tuple(row.first()) == ("x", 1, 2**40, 0.5, None)
    assert query_with_parameters(spark, "select 1 as one").first().one == 1
    quoted = query_with_parameters(spark, "select 'a?''?' as `q?`, ? as b -- why?\n /* ? */", [7])
    assert quoted.columns == ["q?", "b"] and quoted.first().b == 7
    for text, values in (("select ?, ?", [1]), ("select ?", [1, 2])):
        with pytest.raises(ValueError):
            query_with_parameters(spark, text, values)


def test_json_rows_keep_nulls(spark):
    frame = spark.sql("select 1 as a, cast(null as string) as b, date '2024-01-02' as c")
    assert json.loads(json_rows(frame).first().json) == {"a": 1, "b": None, "c": "2024-01-02"}


def test_jdbc_options(spark):
    source = JdbcSource(
        spark,
        "jdbc:postgresql://db/shop",
        {"user": "reader"},
        {"orders": Split("placed_at", "2024-01-01", "2025-01-01", 64)},
    )
    options = source.options("orders")
    assert options["dbtable"] == "public.orders" and options["numPartitions"] == "64"
    assert options["partitionColumn"] == "placed_at" and options["user"] == "reader"
    assert "numPartitions" not in source.options("coupons")


def test_a_large_table_needs_a_split(spark):
    source = JdbcSource(spark, "jdbc:postgresql://host/shop", {})
    with pytest.raises(ValueError, match="order_items needs a split"):
        source.table("order_items")


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_uuid_ranges_hold_each_row_once(spark, parts):
    keys = spark.sql(
        "select if(id = 0, null, substr(md5(string(id)), 1, 8) || '-0000-4000-8000-000000000000') as id"
        " from range(500) union all select '00000000-0000-0000-0000-000000000000'"
        " union all select 'ffffffff-ffff-ffff-ffff-ffffffffffff' union all select '80000000-0000-0000-0000-000000000000'"
    )
    met = UuidSplit("id", parts).predicates()
    assert len(met) == parts
    hits = keys.selectExpr(" + ".join(f"int(coalesce({rule}, false))" for rule in met) + " as n")
    assert {row.n for row in hits.collect()} == {1}


def test_source_tables_get_the_declared_types(spark):
    narrow = spark.sql(
        "select 'x' as more, 2000000000 as quantity, 3000 as unit_price_cents, 'v' as variant_id, 'c' as cart_id, 'i' as id"
    )
    items = typed(narrow, "cart_items")
    assert items.dtypes == spark.createDataFrame([], BRONZE_SCHEMAS["cart_items"]).dtypes
    assert items.selectExpr("quantity * unit_price_cents as value").first().value == 6 * 10**12


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json", "orc"])
def test_files_are_read_with_the_declared_schema(spark, tmp_path, file_format):
    source = FileSource(spark, str(tmp_path), file_format)
    rows = spark.createDataFrame([("c1", "A", "percent", 5)], "id string, code string, discount_type string, discount_value long")
    full = rows.selectExpr(
        "id", "code", "discount_type", "discount_value", "cast(null as bigint) as min_order_cents",
        "cast(null as bigint) as max_redemptions", "cast(null as timestamp) as starts_at",
        "cast(null as timestamp) as ends_at", "true as is_active",
    )
    writer = full.write.option("header", True) if file_format == "csv" else full.write
    writer.format(file_format).save(str(tmp_path / "coupons"))
    found = source.table("coupons")
    assert found.first().asDict()["discount_value"] == 5 and found.first().is_active is True
    assert found.columns == full.columns


def test_schemas_match_the_tables_of_the_test_files(spark):
    assert list(BRONZE_SCHEMAS) == BRONZE_TABLES
    assert sorted(BRONZE_TABLES) == sorted(Testbed.TABLES)
    bed = Testbed(spark, FOLDER)
    for name, ddl in with_keys_as("bigint").items():
        declared = spark.createDataFrame([], ddl).columns
        assert bed.table(name).columns == declared, name


def test_mirror_keeps_everything(spark):
    frame = mirror(spark.range(3), "shop")
    assert frame.count() == 3 and frame.first()._source_system == "shop"
