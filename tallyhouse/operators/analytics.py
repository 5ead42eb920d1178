"""Date-ranged product analytics over the two gold marts.

All bounds are literals, so they prune month partitions and reach the parquet
scan. One-row totals come in as scalar subqueries. Lists are ordered by money
and then by product id, so equal amounts always list alike.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import (
    dollars,
    half_up,
    mean_rating,
    percent,
    ratio,
    shortened,
    total,
    totals,
)
from tallyhouse.operators.ranking import ranked

# Request defaults and bounds.
DEFAULT_RANGE_DAYS = 60
PRESET_RANGE_DAYS = (30, 60, 90)
DEFAULT_LIMIT = 15
LIMIT_BOUNDS = (5, 50)

# Revenue tiers, their labels and the last rank of each.
TIERS = [("top10", "Top 10 products", 10), ("next40", "Next 40 products", 50)]
LONG_TAIL = ("longTail", "Long tail")

SUMMARY_MEASURES = [
    "gross_revenue_cents",
    "net_revenue_cents",
    "refund_cents",
    "discount_cents",
    "cogs_cents",
    "units_sold",
]

PRODUCT_DAY_COLUMNS = [
    "order_date",
    "product_id",
    "product_name",
    "sku_count",
    "order_count",
    "units_sold",
    "gross_revenue_cents",
    "refund_cents",
    "net_revenue_cents",
    "discount_cents",
    "cogs_cents",
    "gross_margin_cents",
]


@dataclass(frozen=True)
class DateRange:
    """Both ends belong to the range."""

    start: dt.date
    end: dt.date


def _day(text: str) -> dt.date:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text, re.ASCII):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return dt.date.fromisoformat(text)


def resolve_range(
    start: str | None = None,
    end: str | None = None,
    days: int = DEFAULT_RANGE_DAYS,
    today: dt.date | None = None,
) -> DateRange:
    """Fill in missing ends: up to today (UTC), ``days`` days including both ends."""
    last = _day(end) if end else today or dt.datetime.now(dt.timezone.utc).date()
    first = _day(start) if start else last - dt.timedelta(days=days - 1)
    if first > last:
        raise ValueError("the range starts after its end")
    return DateRange(first, last)


def checked_limit(limit: int | None = None) -> int:
    chosen = DEFAULT_LIMIT if limit is None else limit
    low, high = LIMIT_BOUNDS
    if isinstance(chosen, bool) or not isinstance(chosen, int) or not low <= chosen <= high:
        raise ValueError(f"limit must be a whole number from {low} to {high}")
    return chosen


def within(frame: DataFrame, span: DateRange) -> DataFrame:
    """Rows in the range, by month partition too where the table has one."""
    rule = f"order_date between date '{span.start}' and date '{span.end}'"
    if "order_month" in frame.columns:
        first, last = span.start.replace(day=1), span.end.replace(day=1)
        rule += f" and order_month between date '{first}' and date '{last}'"
    return frame.where(rule)


def product_days(mart_product_sales: DataFrame, span: DateRange) -> DataFrame:
    return within(mart_product_sales, span).select(PRODUCT_DAY_COLUMNS)


def shared_slice(days: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The range's sums by product and by day, for requests that need both many times.

    They hold what the sections ask of ``days``; a product has a row for each name.
    """
    by_product = days.groupBy("product_id", "product_name").agg(
        F.expr("max(sku_count) as sku_count"), *totals([*SUMMARY_MEASURES, "order_count"])
    )
    by_day = days.groupBy("order_date").agg(*totals(SUMMARY_MEASURES))
    return by_product, by_day


# -- summary ------------------------------------------------------------------


def _daily_value(mart_daily_sales: DataFrame, span: DateRange, value: str) -> Column:
    """One value over the daily mart's rows in the range, as a scalar subquery."""
    return within(mart_daily_sales, span).agg(F.expr(value)).scalar()


def summary_totals(days: DataFrame, mart_daily_sales: DataFrame, span: DateRange) -> DataFrame:
    """One row of sums; zeros when the range is empty."""
    daily = _daily_value(
        mart_daily_sales,
        span,
        f"struct({total('order_count')} as order_count, {total('review_count')} as review_count,"
        f" {mean_rating()} as avg_rating)",
    )
    sums = days.agg(
        *totals(SUMMARY_MEASURES), F.expr("count(distinct product_id) as product_count")
    )
    return sums.select("*", daily.alias("daily")).selectExpr(
        *SUMMARY_MEASURES,
        "product_count",
        "daily.order_count",
        "0L as line_item_count",
        "daily.review_count",
        "daily.avg_rating",
    )


def with_key_figures(sums: DataFrame) -> DataFrame:
    """Margin, average order value and rates on top of the sums."""
    margin = "gross_revenue_cents - cogs_cents"
    return sums.selectExpr(
        *[column for column in sums.columns if column != "avg_rating"],
        f"{half_up('avg_rating', 2)} as avg_rating",
        f"{margin} as gross_margin_cents",
        f"{percent(margin, 'gross_revenue_cents')} as gross_margin_pct",
        f"{half_up(ratio('gross_revenue_cents', 'order_count', '0'))} as aov_cents",
        f"{half_up(ratio('refund_cents', 'gross_revenue_cents', '0'), 4)} as refund_rate",
    )


def summary(days: DataFrame, mart_daily_sales: DataFrame, span: DateRange) -> DataFrame:
    return with_key_figures(summary_totals(days, mart_daily_sales, span))


# -- series ---------------------------------------------------------------------


def _by_day(
    days: DataFrame, mart_daily_sales: DataFrame, span: DateRange, sums: list[str], counted: str
) -> DataFrame:
    """Sums per day with product sales and a count from the daily mart, in date order.

    The result has at most one row per day of the range, so it is gathered and sorted
    in one task, behind the aggregation and the join.
    """
    by_day = days.groupBy("order_date").agg(*totals(sums))
    counts = within(mart_daily_sales, span).select("order_date", counted)
    return (
        by_day.join(counts, "order_date", "left")
        .selectExpr("order_date as date", *sums, f"coalesce({counted}, 0L) as {counted}")
        .repartition(1)
        .sortWithinPartitions("date")
    )


def revenue_over_time(days: DataFrame, mart_daily_sales: DataFrame, span: DateRange) -> DataFrame:
    sums = [column for column in SUMMARY_MEASURES if column != "cogs_cents"]
    return _by_day(days, mart_daily_sales, span, sums, "order_count")


def refunds_over_time(days: DataFrame, mart_daily_sales: DataFrame, span: DateRange) -> DataFrame:
    return _by_day(days, mart_daily_sales, span, ["refund_cents"], "refunded_order_count")


# -- products -------------------------------------------------------------------


def _top(frame: DataFrame, money: str, rows: int) -> DataFrame:
    """The rows with most money; equal amounts by product id."""
    return frame.orderBy(F.col(money).desc(), F.col("product_id").asc()).limit(rows)


def _with_names(top: DataFrame, days: DataFrame, money: str) -> DataFrame:
    """Names for the few products of a list, in its order.

    They are looked up behind the limit: text among the aggregates of all products would
    make Spark sort the rows instead of hashing them. Of several names the last counts.
    """
    names = (
        days.select("product_id", "product_name")
        .join(F.broadcast(top.select("product_id")), "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.array_max(F.collect_set("product_name")).alias("product_name"))
    )
    return top.join(F.broadcast(names), "product_id", "left").orderBy(
        F.col(money).desc(), F.col("product_id").asc()
    )


def top_products(
    days: DataFrame, limit: int | None = None, gross: DataFrame | None = None
) -> DataFrame:
    """The products with the highest gross revenue and their share of all revenue.

    ``sku_count`` is that of the product's best day. ``gross`` is one row with all gross
    revenue, for callers that have it more cheaply than from ``days``.
    """
    per_product = days.groupBy("product_id").agg(
        F.expr("max(sku_count) as sku_count"),
        *totals([*SUMMARY_MEASURES, "order_count"]),
    )
    gross = days.agg(F.expr(total("gross_revenue_cents"))) if gross is None else gross
    all_gross = gross.scalar()
    margin = "gross_revenue_cents - cogs_cents"
    top = _top(per_product, "gross_revenue_cents", checked_limit(limit))
    return (
        _with_names(top, days, "gross_revenue_cents")
        .select("*", all_gross.alias("all_gross"))
        .selectExpr(
            "product_id",
            "product_name",
            *per_product.columns[1:],
            f"{margin} as gross_margin_cents",
            f"{percent(margin, 'gross_revenue_cents')} as gross_margin_pct",
            f"{percent('gross_revenue_cents', 'all_gross')} as revenue_share_pct",
            f"{half_up(ratio('gross_revenue_cents', 'units_sold', '0'))} as avg_unit_price_cents",
        )
    )


def refunds_by_product(days: DataFrame, limit: int | None = None) -> DataFrame:
    """The products with the highest refunds; products without any do not count."""
    refunded = (
        days.groupBy("product_id")
        .agg(*totals(["refund_cents", "units_sold"]))
        .where("refund_cents > 0")
    )
    all_refunds = refunded.agg(F.expr(total("refund_cents"))).scalar()
    top = _top(refunded, "refund_cents", checked_limit(limit))
    return (
        _with_names(top, days, "refund_cents")
        .select("*", all_refunds.alias("all_refunds"))
        .selectExpr(
            "product_id",
            "product_name",
            *refunded.columns[1:],
            f"{percent('refund_cents', 'all_refunds')} as refund_share_pct",
            f"{half_up(ratio('refund_cents', 'units_sold', '0'))} as refund_per_unit_cents",
        )
    )


def refund_summary(days: DataFrame, mart_daily_sales: DataFrame, span: DateRange) -> DataFrame:
    orders = _daily_value(mart_daily_sales, span, total("refunded_order_count"))
    return (
        days.agg(*totals(["refund_cents", "gross_revenue_cents"]))
        .select("*", orders.alias("refunded_order_count"))
        .selectExpr(
            "*",
            f"{half_up(ratio('refund_cents', 'gross_revenue_cents', '0'), 4)} as refund_rate",
        )
    )


# -- portfolio ------------------------------------------------------------------


def _product_revenue(days: DataFrame) -> DataFrame:
    return days.groupBy("product_id").agg(*totals(["gross_revenue_cents"]))


def _all_revenue(days: DataFrame) -> Column:
    """Gross revenue and number of products of the range as one struct value."""
    return days.agg(
        F.expr(
            f"struct({total('gross_revenue_cents')} as gross,"
            " count(distinct product_id) as products)"
        )
    ).scalar()


def portfolio_ranks(days: DataFrame) -> DataFrame:
    """Every product with its revenue rank and share."""
    by_revenue = [F.col("gross_revenue_cents").desc(), F.col("product_id").asc()]
    return (
        ranked(_product_revenue(days), *by_revenue, name="revenue_rank")
        .select("*", _all_revenue(days).alias("whole"))
        .selectExpr(
            "product_id",
            "gross_revenue_cents",
            "revenue_rank",
            "whole.gross as total_gross",
            "whole.products as product_count",
            f"{ratio('gross_revenue_cents', 'whole.gross', '0')} as share",
        )
    )


def _leaders(days: DataFrame) -> DataFrame:
    """The products of the ranked tiers, numbered; no more rows than the last tier's rank."""
    place = Window.orderBy(F.col("gross_revenue_cents").desc(), F.col("product_id").asc())
    best = _top(_product_revenue(days), "gross_revenue_cents", TIERS[-1][2])
    return best.withColumn("place", F.row_number().over(place))


def portfolio_buckets(days: DataFrame) -> DataFrame:
    """Always three rows. The long tail is what the ranked tiers leave of the totals."""
    sums, buckets, above = [], [], 0
    rest_n, rest_cents = "whole.products", "whole.gross"

    def bucket(tier: str, label: str, products: str, cents: str) -> str:
        return (
            f"struct('{tier}' as tier, '{label}' as label, {products} as product_count,"
            f" {cents} as gross_revenue_cents,"
            f" {percent(cents, 'whole.gross')} as revenue_share_pct)"
        )

    for tier, label, last in TIERS:
        inside = f"place > {above} and place <= {last}"
        sums.append(F.expr(f"count_if({inside}) as {tier}_n"))
        sums.append(F.expr(f"{total(f'if({inside}, gross_revenue_cents, 0)')} as {tier}_cents"))
        buckets.append(bucket(tier, label, f"{tier}_n", f"{tier}_cents"))
        rest_n, rest_cents = f"{rest_n} - {tier}_n", f"{rest_cents} - {tier}_cents"
        above = last
    buckets.append(bucket(*LONG_TAIL, rest_n, f"({rest_cents})"))
    return (
        _leaders(days)
        .agg(*sums)
        .select("*", _all_revenue(days).alias("whole"))
        .selectExpr(f"inline(array({', '.join(buckets)}))")
    )


def portfolio_concentration(days: DataFrame) -> DataFrame:
    """Herfindahl index and the revenue share of the leading 10 and 50 products."""
    leading = ", ".join(
        f"{total(f'if(place <= {last}, gross_revenue_cents, 0)')} as top{last}"
        for _, _, last in TIERS
    )
    return (
        _product_revenue(days)
        .select("*", days.agg(F.expr(total("gross_revenue_cents"))).scalar().alias("everything"))
        .selectExpr(f"{ratio('gross_revenue_cents', 'everything', '0')} as share", "everything")
        .agg(
            F.expr("coalesce(sum(share * share), 0) as concentration"),
            F.expr("max(everything) as everything"),
        )
        .select("*", _leaders(days).agg(F.expr(f"struct({leading})")).scalar().alias("leading"))
        .selectExpr(
            f"{half_up('concentration', 4)} as herfindahl_index",
            *[
                f"{percent(f'leading.top{last}', 'everything')} as top{last}_revenue_share_pct"
                for _, _, last in TIERS
            ],
        )
    )


# -- chart feeds ------------------------------------------------------------------


def revenue_chart(series: DataFrame) -> DataFrame:
    """The revenue series in dollars with a month-day label."""
    return series.selectExpr(
        "date",
        "date_format(date, 'MM-dd') as label",
        f"{dollars('gross_revenue_cents')} as gross",
        f"{dollars('net_revenue_cents')} as net",
        f"{dollars('refund_cents')} as refund",
        "gross_revenue_cents as gross_cents",
        "net_revenue_cents as net_cents",
        "refund_cents",
    ).orderBy("date")


def top_products_chart(top: DataFrame, bars: int = 10) -> DataFrame:
    """The leading bars, smallest first as a horizontal bar chart draws them."""
    first = _top(top, "gross_revenue_cents", bars)
    return first.orderBy(F.col("gross_revenue_cents").asc(), F.col("product_id").desc()).selectExpr(
        f"{shortened('product_name', 28, 26)} as name",
        "product_name as full_name",
        f"{dollars('gross_revenue_cents')} as revenue",
        "gross_revenue_cents as revenue_cents",
        "revenue_share_pct as share",
        "units_sold as units",
        "gross_margin_pct as margin_pct",
    )


def refunds_chart(refunded: DataFrame, bars: int = 8) -> DataFrame:
    first = _top(refunded, "refund_cents", bars)
    return first.orderBy(F.col("refund_cents").asc(), F.col("product_id").desc()).selectExpr(
        f"{shortened('product_name', 24, 22)} as name",
        "product_name as full_name",
        f"{dollars('refund_cents')} as refund",
        "refund_share_pct as share",
    )
