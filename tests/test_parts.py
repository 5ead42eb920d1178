"""Facts of many rows are joined and written in parts."""

import pyarrow.parquet as pq
import pytest

from checks.catalogue import Layers
from checks.testbed import Testbed
from tallyhouse.operators import joins
from tallyhouse.operators.joins import joined_in_parts
from tallyhouse.plans import data_tests
from tallyhouse.plans.medallion import SILVER_MODELS, silver_over
from tallyhouse.plans.refresh import refresh_silver
from tallyhouse.sources.warehouse import Warehouse


def same(left, right):
    left = left.select(right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_parts_keep_every_pair(spark, monkeypatch):
    left = spark.sql("select * from values (1L, 'a'), (1L, 'a'), (2L, 'b'), (3L, 'c'), (null, 'd') as l(key, x)")
    right = spark.sql("select * from values (1L, 'p'), (1L, 'q'), (3L, 'r'), (null, 's') as r(id, y)")
    sides = [(left, "key"), (right, "id")]
    assert joined_in_parts(sides) == [[left, right]]
    monkeypatch.setattr(joins, "ROWS_A_PART", 2)
    parts = joined_in_parts(sides)
    assert len(parts) == 3  # five rows
    pairs = [row for a, b in parts for row in a.join(b, a.key == b.id, "left").collect()]
    whole = left.join(right, left.key == right.id, "left").collect()
    assert sorted(map(repr, pairs)) == sorted(map(repr, whole)) and len(whole) == 7
    monkeypatch.setattr(joins, "PARTS", 2)
    assert len(joined_in_parts(sides)) == 2
    texts = right.withColumn("id", right.id.cast("string"))
    assert joined_in_parts([(left, "key"), (texts, "id")]) == [[left, texts]]


@pytest.mark.parametrize("name", [name for name, model in SILVER_MODELS.items() if model.by])
def test_a_fact_written_in_parts_is_the_fact(spark, tmp_path, monkeypatch, name):
    bronze = Testbed(spark, "/root/testdata/sf0.001")
    whole = silver_over(bronze).build(name)
    monkeypatch.setattr(joins, "ROWS_A_PART", 100)
    monkeypatch.setattr(joins, "PARTS", 3)
    parts = silver_over(bronze).parts(name)
    assert len(parts) == 3 and not any(part.isEmpty() for part in parts)
    warehouse = Warehouse(spark, str(tmp_path), "parts_")
    warehouse.create_databases()
    month_of = SILVER_MODELS[name].month_of
    assert same(warehouse.replace("silver", name, parts, month_of), whole)


def test_a_refresh_writes_facts_in_parts(spark, tmp_path, monkeypatch):
    bronze = Testbed(spark, "/root/testdata/sf0.001")
    warehouse = Warehouse(spark, str(tmp_path), "refreshed_")
    warehouse.create_databases()
    for name in ("orders", "payments"):
        warehouse.replace("bronze", name, bronze.table(name))
    monkeypatch.setattr(joins, "ROWS_A_PART", 500)
    refresh_silver(warehouse, ["fct_orders", "fct_payments"])
    month = tmp_path.glob("refreshed_silver/fct_payments/*/order_month=1997-05-01/*.parquet")
    assert len({file.name.split("-")[2] for file in month}) > 1  # of several writes
    assert same(warehouse.table("silver", "fct_payments"), silver_over(bronze).build("fct_payments"))


def test_a_fact_brought_up_to_date_begins_in_parts(spark, monkeypatch):
    whole = silver_over(Testbed(spark, "/root/testdata/sf0.001")).build("fct_payments")
    monkeypatch.setattr(joins, "ROWS_A_PART", 500)
    wrote = []
    replace = Warehouse.replace
    monkeypatch.setattr(
        Warehouse, "replace", lambda self, layer, name, frame, *x: wrote.append(frame) or replace(self, layer, name, frame, *x)
    )
    made = Layers(spark, "/root/testdata/sf0.001").incremental_fact("fct_payments")
    assert len(wrote[0]) > 1 and same(made, whole)


def test_tables_are_tested_one_after_the_other(spark, given, monkeypatch):
    parents = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    children = spark.createDataFrame([(1, 1), (2, 9), (None, 1)], "id long, parent_id long")
    layers = {"silver": given(p=parents, c=children)}
    checks = [
        data_tests.unique("silver", "p", "id"),
        data_tests.related("silver", "c", "parent_id", ("silver", "p", "id")),
        data_tests.not_null("silver", "c", "id"),
        data_tests.not_null("silver", "p", "id"),
    ]
    at_once = data_tests.outcomes(layers, checks)
    calls = []
    outcomes = data_tests.outcomes
    monkeypatch.setattr(data_tests, "outcomes", lambda x, own: calls.append(len(own)) or outcomes(x, own))
    found = data_tests.outcomes_by_table(layers, checks)
    assert calls == [2, 2] and found.schema == at_once.schema
    assert sorted(found.collect()) == sorted(at_once.collect())
    assert [row.failures for row in found.orderBy("check_name", "table_name").collect()] == [1, 0, 1, 1]


def test_marts_are_written_before_the_silver_they_are_held_against(spark, monkeypatch):
    asked = []
    requests = Layers.requests
    monkeypatch.setattr(Layers, "requests", lambda self, layer: asked.append(layer) or requests(self, layer))
    rows = Layers(spark, "/root/testdata/sf0.001").reconciled.collect()
    assert asked[0] == "gold" and {row.layer for row in rows} == {"bronze", "silver", "gold"}
    assert all(row.agrees for row in rows)


def test_files_keep_differences(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), "files_")
    warehouse.create_databases()
    rows = spark.range(5000).selectExpr("id * 7919 as id", "concat('key-', id) as name")
    assert same(warehouse.replace("silver", "t", rows), rows)
    file = next(tmp_path.glob("files_silver/t/*/part-*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    assert "DELTA_BINARY_PACKED" in group.column(0).encodings and group.column(0).compression == "ZSTD"
