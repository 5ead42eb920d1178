"""Shuffle partitions, and what shuffles leave on disk."""

from pyspark.sql import functions as F

from checks.catalogue import initial_partitions
from tallyhouse.session import INITIAL_PARTITIONS, LEAST_PARTITIONS, ROWS_A_PARTITION, configure, partitions_for
from tallyhouse.sources.warehouse import Warehouse


def test_partitions_grow_with_the_rows():
    assert [partitions_for(n) for n in (0, 1, ROWS_A_PARTITION, ROWS_A_PARTITION + 1)] == [1, 1, 1, 2]


def test_partitions_follow_the_largest_file(spark, tmp_path):
    for name, rows in (("small", 10), ("large", 20 * ROWS_A_PARTITION)):
        for table in ("lineitem", "orders", "events"):
            size = rows if table == "lineitem" else 5
            spark.range(size).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert initial_partitions(spark, f"{tmp_path}/small") == least
    assert initial_partitions(spark, f"{tmp_path}/large") == max(20, least)
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        configure(spark, initial_partitions(spark, f"{tmp_path}/large"))
        assert int(spark.conf.get(INITIAL_PARTITIONS)) == max(20, least)
    finally:
        spark.conf.set(INITIAL_PARTITIONS, before) if before else spark.conf.unset(INITIAL_PARTITIONS)


def test_written_tables_are_small_and_shuffles_are_cleaned(spark, tmp_path):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    warehouse = Warehouse(spark, str(tmp_path), "cleaned_")
    warehouse.create_databases()
    days = spark.range(100).selectExpr("id", "date_add(date '2024-01-01', cast(id as int)) as order_date")
    for month_of, name in (("order_date", "by_month"), (None, "whole")):
        written = warehouse.replace("silver", name, days.repartition(3, "id"), month_of)
        assert written.count() == 100
        files = [f for f in (tmp_path / "cleaned_silver" / name).rglob("part-*.parquet") if ".months" not in str(f)]
        assert files and all(".zstd." in f.name for f in files)
        # A frame that is run again makes its shuffle files anew.
        assert len(written.orderBy("id").collect()) == 100
    counted = days.groupBy("order_date").count()
    assert len(counted.collect()) == len(counted.collect()) == 100


def test_a_large_shuffle_keeps_its_partitions(spark):
    keys = (INITIAL_PARTITIONS, LEAST_PARTITIONS)
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        configure(spark, 24)
        groups = spark.range(400_000).groupBy((F.col("id") * 7919 % 200_003).alias("key")).count()
        assert groups.rdd.getNumPartitions() == 24
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path):
    for name, rows in (("many", 1_500_000), ("few", 300)):
        keys = spark.range(rows).selectExpr("pmod(xxhash64(id), 1000) as key", "id % 2 as kind")
        keys.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    size = sum(file.stat().st_size for file in (tmp_path / "many").glob("part-*"))
    many, few = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("many", "few"))
    assert size < 5_000_000  # half of the limit of a broadcast

    def plan(right):
        return many.join(right, "key")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" not in plan(many.withColumnRenamed("kind", "other"))
    assert "BroadcastHashJoin" in plan(few.withColumnRenamed("kind", "other"))


def test_shuffled_rows_of_megabytes_are_not_broadcast(spark):
    def final_plan(rows):
        # Grouped, so that sizes are only known once the rows are shuffled.
        many = spark.range(1_500_000).selectExpr("id % 700001 as key", "id").groupBy("key").agg(F.max("id").alias("a"))
        other = spark.range(rows).selectExpr("xxhash64(id) as key", "id").groupBy("key").agg(F.max("id").alias("b"))
        joined = many.join(other, "key", "left")
        joined.collect()
        return joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    assert "BroadcastHashJoin" not in final_plan(200_000)  # 3 to 10 MB as compressed
    assert "BroadcastHashJoin" in final_plan(1_000)
