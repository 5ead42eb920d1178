"""Marts by period next to counts over the lines themselves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import periods


def lines_of(spark, size=4000, variants=70_000):
    draw = random.Random(3)
    days = [dt.date(2023, 12, 20) + dt.timedelta(days=7 * i) for i in range(30)]
    rows = [
        (draw.choice(days), p := draw.randrange(3), 10**9 * p + 97 * draw.choice([draw.randrange(9), draw.randrange(variants)]), draw.random() < 0.9)
        for _ in range(size)
    ]
    return spark.createDataFrame(rows, "order_date date, product_id long, variant_id long, is_revenue_order boolean")


@pytest.mark.parametrize("unit", periods.UNITS)
def test_merged_bitmaps_count_the_lines_variants(spark, unit):
    # Product 0 has variants in three buckets of 32,768 numbers.
    dim = spark.range(3).withColumnRenamed("id", "product_id").crossJoin(spark.range(70_000)).selectExpr(
        "product_id", "product_id * 1000000000 + 97 * id as variant_id"
    )
    lines = lines_of(spark)
    sets = periods.sold_variants(lines, periods.variant_numbers(dim))
    assert sets.select(F.max("bucket")).first()[0] == 3
    found = {tuple(r) for r in periods.sku_counts(sets, unit).collect()}
    wanted = lines.where("is_revenue_order").groupBy(periods.period(unit), "product_id").agg(F.countDistinct("variant_id"))
    assert found == {tuple(r) for r in wanted.collect()}


def test_bitmaps_of_few_variants_are_short(spark):
    dim = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "product_id long, variant_id long")
    lines = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 6, True)], "order_date date, product_id long, variant_id long, is_revenue_order boolean")
    row = periods.sold_variants(lines, periods.variant_numbers(dim)).first()
    assert bytes(row.variant_bits) == b"\x02" and row.bucket == 1


def test_known_numbers_stay(spark):
    known = spark.createDataFrame([(5, 1, 2), (6, 1, 1)], "variant_id long, product_id long, number long")
    dim = spark.createDataFrame([(1, 5), (1, 6), (1, 2), (1, 3), (2, 1)], "product_id long, variant_id long")
    found = {(r.variant_id, r.number) for r in periods.extended_numbers(known.select("variant_id", "number"), dim).collect()}
    assert found == {(5, 2), (6, 1), (2, 3), (3, 4), (1, 1)}


def test_unknown_unit_is_refused():
    with pytest.raises(ValueError):
        periods.period("DAY")


def test_bitmaps_are_those_of_the_builtin_aggregate_without_its_buffer(spark):
    """Spark's own bitmap aggregates hold 4 KB for every day and product."""
    dim = spark.range(2).withColumnRenamed("id", "product_id").crossJoin(spark.range(40_000)).selectExpr(
        "product_id", "product_id * 1000000000 + 97 * id as variant_id"
    )
    numbers = periods.variant_numbers(dim)
    lines = lines_of(spark, 3000, 40_000)
    sets = periods.sold_variants(lines, numbers)
    wanted = (
        lines.where("is_revenue_order").join(numbers, "variant_id")
        .groupBy("order_date", "product_id", F.expr("bitmap_bucket_number(number)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bits"))
    )
    found = {tuple(r)[:3]: bytes(r.variant_bits) for r in sets.collect()}
    assert found == {tuple(r)[:3]: bytes(r.bits).rstrip(b"\0") for r in wanted.collect()}
    for frame in (sets, periods.sku_counts(sets, "MONTH")):
        assert "bitmap_" not in frame._jdf.queryExecution().optimizedPlan().toString().replace(
            "bitmap_bucket_number", "").replace("bitmap_bit_position", "")
