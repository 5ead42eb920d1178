"""The fused checks next to the single ones, and what the runner does with them."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality
from tallyhouse.plans import data_tests as T
from tallyhouse.sources.warehouse import Warehouse

PARENTS = [(1, "a"), (2, "b"), (2, "b"), (None, "c")]
CHILDREN = [(1, 1, "x", 5), (2, 1, "x", 0), (3, 9, "odd", None), (3, 9, None, -1), (None, None, "odder", 3), (None, 2, "x", 3)]


@pytest.fixture
def lake(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), f"tests{abs(hash(str(tmp_path)))}_")
    warehouse.create_databases()
    with warehouse.release() as release:
        release.replace("silver", "p", spark.createDataFrame(PARENTS, "id long, name string"))
        release.replace("silver", "c", spark.createDataFrame(CHILDREN, "id long, parent_id long, kind string, n int"))
    return warehouse


CHECKS = [
    T.unique("silver", "p", "id"),
    T.unique("silver", "p", "id", "name"),
    T.unique("silver", "c", "id"),
    T.unique("silver", "c", "parent_id", "kind"),
    T.not_null("silver", "p", "id"),
    T.not_null("silver", "c", "id"),
    T.not_null("silver", "c", "kind"),
    T.related("silver", "c", "parent_id", ("silver", "p", "id")),
    T.accepted("silver", "c", "kind", ["x"], quality.WARN),
    T.holds("silver", "c", "n", "positive", "n > 0"),
    T.kept("silver", "c", "positive", "n > 0"),
]


def test_fused_checks_find_what_single_ones_do(lake):
    p, c = lake.table("silver", "p"), lake.table("silver", "c")
    single = quality.all_of([
        quality.unique(p, "silver_p", "id"),
        quality.unique(p, "silver_p", "id", "name"),
        quality.unique(c, "silver_c", "id"),
        quality.unique(c, "silver_c", "parent_id", "kind"),
        quality.not_null(p, "silver_p", "id"),
        quality.not_null(c, "silver_c", "id", "kind"),
        quality.relationships(c, "silver_c", "parent_id", p, "id"),
        quality.accepted_values(c, "silver_c", "kind", ["x"], quality.WARN),
        quality.holds(c, "silver_c", "n", "positive", F.col("n") > 0),
        quality.dropped(c, "silver_c", "positive", F.col("n") > 0),
    ])
    found = T.outcomes({"silver": lake.layer("silver")}, CHECKS).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, single.collect()))
    assert {r.failures for r in found} == {1, 2, 3} and len(found) == len(CHECKS)


def test_empty_tables_pass(lake, given, spark):
    empty = given(p=lake.table("silver", "p").limit(0), c=lake.table("silver", "c").limit(0))
    assert {r.status for r in T.outcomes({"silver": empty}, CHECKS).collect()} == {"pass"}


def test_a_table_is_read_twice_at_most(lake):
    plan = T.outcomes({"silver": lake.layer("silver")}, CHECKS)._jdf.queryExecution().executedPlan().toString()
    # Reused exchanges only show once the plan runs; the scans differ by what they are for.
    frame = T.outcomes({"silver": lake.layer("silver")}, CHECKS)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for table in ("p", "c"):
        scans = re.findall(rf"Scan parquet \S*silver_{table}__version", plan)
        assert 1 <= len(scans) <= 2, (table, len(scans), plan)
    assert plan.count("Exchange") > 0


def test_errors_raise_and_warnings_do_not(lake, spark):
    warnings = [c for c in CHECKS if c.severity == quality.WARN]
    result = T.run(lake, warnings, now=dt.datetime(2024, 1, 1))
    assert {r.status for r in result.collect()} == {"warn"}
    with pytest.raises(T.DataTestError) as found:
        T.run(lake, CHECKS, now=dt.datetime(2024, 1, 2))
    assert any("silver_c.parent_id relationships: 2" in x for x in found.value.failed)
    kept = lake.table("gold", T.RESULTS)
    assert kept.select("run_id").distinct().count() == 2 and kept.count() == len(warnings) + len(CHECKS)


def test_a_failed_check_keeps_the_old_tables(lake, spark):
    good = spark.createDataFrame([(7, "g")], "id long, name string")
    with lake.release() as release:
        release.replace("silver", "p", good)
        T.run(release, [T.unique("silver", "p", "id")])
    assert lake.table("silver", "p").count() == 1
    bad = good.unionByName(good)
    with pytest.raises(T.DataTestError), lake.release() as release:
        release.replace("silver", "p", bad)
        T.run(release, [T.unique("silver", "p", "id")])
    assert lake.table("silver", "p").count() == 1
    statuses = [r.status for r in lake.table("gold", T.RESULTS).orderBy("tested_at").collect()]
    assert statuses == ["pass", "error"]
