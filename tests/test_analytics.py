import datetime as dt

import pytest

from tallyhouse.operators import analytics
from tallyhouse.operators.analytics import DateRange, checked_limit, resolve_range
from tallyhouse.operators.ranking import ranked
from tallyhouse.plans.bundle import products_bundle, products_response, section_rows, shared_bundle
from pyspark.sql import functions as F

SPAN = DateRange(dt.date(2024, 1, 1), dt.date(2024, 1, 31))
PRODUCT = (
    "order_date date, product_id long, product_name string, sku_count long, order_count long,"
    " units_sold long, gross_revenue_cents long, refund_cents long, net_revenue_cents long,"
    " discount_cents long, cogs_cents long, gross_margin_cents long, gross_margin_pct double"
)
DAILY = (
    "order_date date, order_count long, refunded_order_count long, review_count long,"
    " avg_rating double"
)


def product(day, key, gross, refund=0, units=1, skus=1, cogs=0):
    return (
        dt.date(2024, 1, day), key, f"Product {key}", skus, 1, units, gross, refund,
        gross - refund, 0, cogs, gross - cogs, None,
    )


def marts(spark, products, daily=()):
    return spark.createDataFrame(list(products), PRODUCT), spark.createDataFrame(
        [(dt.date(2024, 1, day), *rest) for day, *rest in daily], DAILY
    )


def test_range_defaults():
    today = dt.date(2024, 6, 30)
    assert resolve_range(today=today) == DateRange(dt.date(2024, 5, 2), today)
    assert resolve_range(end="2024-03-01").start == dt.date(2024, 1, 2)
    assert (resolve_range(end="2024-03-01", days=30).start) == dt.date(2024, 2, 1)
    assert resolve_range("2024-02-03", "2024-02-03").start == dt.date(2024, 2, 3)


@pytest.mark.parametrize(
    "start, end",
    [("2024-02-02", "2024-02-01"), ("2024-2-1", None), ("2024-02-30", None), (None, "x"),
     ("20240201", None), ("2024-02-01T00:00", None)],
)
def test_bad_ranges(start, end):
    with pytest.raises(ValueError):
        resolve_range(start, end, today=dt.date(2025, 1, 1))


@pytest.mark.parametrize("limit", [4, 51, 0, -1, 7.5, True, "9"])
def test_bad_limits(limit):
    with pytest.raises(ValueError):
        checked_limit(limit)


def test_limits():
    assert [checked_limit(limit) for limit in (None, 5, 50)] == [15, 5, 50]


def test_empty_range(spark):
    mart, daily = marts(spark, [])
    frames = products_bundle(mart, daily, SPAN)
    rows = {name: frame.collect() for name, frame in frames.items()}
    assert len(rows["summary"]) == 1
    summary = rows["summary"][0].asDict()
    assert summary.pop("avg_rating") is None
    assert set(summary.values()) == {0}
    assert [row.tier for row in rows["portfolio_buckets"]] == ["top10", "next40", "longTail"]
    assert {row.product_count for row in rows["portfolio_buckets"]} == {0}
    concentration = rows["portfolio_concentration"][0]
    assert concentration.herfindahl_index == 0 and concentration.top10_revenue_share_pct == 0
    assert rows["refund_summary"][0].refund_rate == 0
    for name in ("revenue_over_time", "top_products", "refunds_over_time", "refunds_by_product"):
        assert rows[name] == []


def test_fewer_products_than_a_tier(spark):
    mart, _ = marts(spark, [product(1, key, 100) for key in range(3)])
    rows = {row.tier: row for row in analytics.portfolio_buckets(mart).collect()}
    assert rows["top10"].product_count == 3 and rows["top10"].revenue_share_pct == 100
    assert rows["next40"].product_count == rows["longTail"].product_count == 0
    index = analytics.portfolio_concentration(mart).collect()[0]
    assert index.herfindahl_index == 0.3333 and index.top50_revenue_share_pct == 100


def test_tiers_of_many_products(spark):
    mart, _ = marts(spark, [product(1, key, 1000 - key) for key in range(120)])
    rows = {row.tier: row for row in analytics.portfolio_buckets(mart).collect()}
    assert [rows[t].product_count for t in ("top10", "next40", "longTail")] == [10, 40, 70]
    assert rows["longTail"].gross_revenue_cents == sum(1000 - key for key in range(50, 120))


def test_no_refunds(spark):
    mart, daily = marts(spark, [product(1, 1, 100)])
    assert analytics.refunds_by_product(mart).collect() == []


def test_top_products_ties_and_figures(spark):
    mart, _ = marts(
        spark,
        [product(1, 5, 300, skus=2, units=2, cogs=100), product(2, 5, 100, skus=3, units=1),
         product(1, 4, 400, units=0), product(1, 6, 200, units=3)],
    )
    rows = analytics.top_products(mart, 5).collect()
    assert [row.product_id for row in rows] == [4, 5, 6]
    assert rows[1].sku_count == 3 and rows[1].avg_unit_price_cents == 133
    assert rows[1].gross_margin_pct == 75.0 and rows[1].revenue_share_pct == 40.0
    assert rows[0].avg_unit_price_cents == 0
    assert rows[2].avg_unit_price_cents == 67


def test_halves_round_up(spark):
    mart, daily = marts(spark, [product(1, 1, 5, units=2)], [(1, 2, 0, 4, 2.125)])
    row = analytics.summary(mart, daily, SPAN).collect()[0]
    assert row.aov_cents == 3 and row.avg_rating == 2.13


def test_mean_rating_weighs_days_by_reviews(spark):
    mart, daily = marts(
        spark, [product(1, 1, 500)], [(1, 1, 0, 3, 5.0), (2, 1, 0, 1, 1.0), (3, 1, 0, 0, None)]
    )
    row = analytics.summary(mart, daily, SPAN).collect()[0]
    assert row.avg_rating == 4.0 and row.review_count == 4 and row.order_count == 3


def test_refunded_orders_do_not_multiply(spark):
    mart, daily = marts(
        spark, [product(1, 1, 500, 10), product(1, 2, 500, 20)], [(1, 4, 3, 0, None)]
    )
    rows = analytics.refunds_over_time(mart, daily, SPAN).collect()
    assert [(row.refund_cents, row.refunded_order_count) for row in rows] == [(30, 3)]


def test_chart_labels(spark):
    long_name = "x" * 29
    top = spark.createDataFrame(
        [(1, long_name, 101, 2.0, 3, 4.0), (2, "y" * 28, 99, 1.0, 1, 1.0)],
        "product_id long, product_name string, gross_revenue_cents long,"
        " revenue_share_pct double, units_sold long, gross_margin_pct double",
    )
    rows = analytics.top_products_chart(top).collect()
    assert [row.name for row in rows] == ["y" * 28, "x" * 26 + "…"]
    assert rows[1].revenue == 1.01 and rows[1].full_name == long_name


def test_ranks_over_several_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(0, 5000, 1, 7).selectExpr("id", "(id * 7919) % 50 as value")
        found = ranked(frame, F.col("value").desc(), F.col("id").asc(), name="place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wanted = sorted(range(5000), key=lambda key: (-((key * 7919) % 50), key))
    assert [row.id for row in sorted(found, key=lambda row: row.place)] == wanted
    assert sorted(row.place for row in found) == list(range(1, 5001))


def test_response(spark):
    mart, daily = marts(spark, [product(1, 1, 500, 10)], [(1, 4, 3, 1, 4.0)])
    answer = products_response(mart, daily, "2024-01-01", "2024-01-31")
    assert answer["meta"]["from"] == "2024-01-01" and answer["meta"]["defaultRangeDays"] == 60
    assert answer["summary"]["grossRevenueCents"] == 500
    assert answer["revenueOverTime"][0]["date"] == "2024-01-01"
    assert answer["topProducts"][0]["revenueSharePct"] == 100
    assert [bucket["tier"] for bucket in answer["portfolio"]["buckets"]] == [
        "top10", "next40", "longTail",
    ]
    assert answer["portfolio"]["herfindahlIndex"] == 1
    assert answer["reimbursements"]["refundedOrderCount"] == 3
    assert answer["reimbursements"]["byProduct"][0]["refundPerUnitCents"] == 10


def test_shared_slice_gives_the_same_sections_from_two_scans(spark, tmp_path):
    mart, daily = marts(
        spark,
        [product(day, key, 100 * key + day, key) for day in (1, 2, 9) for key in range(1, 70)],
        [(1, 4, 3, 1, 4.0), (2, 5, 1, 2, 3.5), (9, 2, 0, 0, None)],
    )
    mart.write.parquet(str(tmp_path / "mart"))
    daily.write.parquet(str(tmp_path / "daily"))
    mart, daily = (spark.read.parquet(str(tmp_path / name)) for name in ("mart", "daily"))
    alone = {name: [tuple(r) for r in frame.collect()] for name, frame in products_bundle(mart, daily, SPAN, 10).items()}
    with shared_bundle(mart, daily, SPAN, 10) as frames:
        shared = {name: [tuple(r) for r in frame.collect()] for name, frame in frames.items()}
        plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in frames.values()]
        assert all("InMemoryRelation" in plan for plan in plans)
        rows = section_rows(frames).collect()
    assert shared == alone
    assert {r.section for r in rows} == set(alone) and len([r for r in rows if r.section == "top_products"]) == 10 * 12


def test_top_lists_sort_no_rows_for_names(spark):
    mart, daily = marts(spark, [product(1, 1, 500, 10)])
    for frame in (analytics.top_products(mart, 15), analytics.refunds_by_product(mart, 15)):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()
