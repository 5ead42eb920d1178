"""All product analytics of one request: frames, or the nested response."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import analytics
from tallyhouse.operators.analytics import DEFAULT_RANGE_DAYS, DateRange


def _sections(
    products: DataFrame, days: DataFrame, daily: DataFrame, span: DateRange, limit: int | None
) -> dict[str, DataFrame]:
    return {
        "summary": analytics.summary(products, daily, span),
        "revenue_over_time": analytics.revenue_over_time(days, daily, span),
        "top_products": analytics.top_products(products, limit),
        "portfolio_concentration": analytics.portfolio_concentration(products),
        "portfolio_buckets": analytics.portfolio_buckets(products),
        "refund_summary": analytics.refund_summary(days, daily, span),
        "refunds_over_time": analytics.refunds_over_time(days, daily, span),
        "refunds_by_product": analytics.refunds_by_product(products, limit),
    }


def products_bundle(
    mart_product_sales: DataFrame,
    mart_daily_sales: DataFrame,
    span: DateRange,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """One frame per section. Every frame has few rows: days, tiers or a top list.

    Each reads the marts for itself; ``shared_bundle`` reads them once for all.
    """
    days = analytics.product_days(mart_product_sales, span)
    return _sections(days, days, mart_daily_sales, span, limit)


@contextmanager
def shared_bundle(
    mart_product_sales: DataFrame,
    mart_daily_sales: DataFrame,
    span: DateRange,
    limit: int | None = None,
) -> Iterator[dict[str, DataFrame]]:
    """The sections over one aggregate by product, one by day, and the days of the daily mart.

    The three are kept (in memory, else on disk) while the sections are read: the product
    mart's slice is scanned twice, the daily mart's once, whatever the number of sections.
    What a lost executor kept is made again.
    """
    by_product, by_day = analytics.shared_slice(analytics.product_days(mart_product_sales, span))
    daily = analytics.within(mart_daily_sales, span)
    kept = [frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in (by_product, by_day, daily)]
    try:
        yield _sections(*kept, span, limit)
    finally:
        for frame in kept:
            frame.unpersist()


ITEMS = ("date", "product_id", "tier")  # what the rows of a section are known by


def section_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """All figures of the sections as rows of (section, item, key, value).

    ``item`` is a row's day, product or tier, empty in sections of one row; values are exact to
    six digits. Missing figures have no row.
    """
    parts = []
    for section, frame in frames.items():
        item = next((c for c in frame.columns if c in ITEMS), None)
        figures = [c for c, kind in frame.dtypes if kind != "string" and c != item]
        values = F.array(
            *(F.struct(F.lit(c).alias("key"), F.col(c).cast("decimal(28,6)").alias("value")) for c in figures)
        )
        known = F.col(item).cast("string") if item else F.lit("")
        parts.append(
            frame.select(F.lit(section).alias("section"), known.alias("item"), F.explode(values).alias("x"))
            .select("section", "item", "x.key", "x.value")
            .where("value is not null")
        )
    return reduce(DataFrame.unionByName, parts)


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(word.capitalize() for word in rest)


def _objects(frame: DataFrame) -> list[dict[str, object]]:
    def plain(value: object) -> object:
        return value.isoformat() if isinstance(value, dt.date) else value

    return [
        {_camel(key): plain(value) for key, value in row.asDict().items()}
        for row in frame.collect()
    ]


def products_response(
    mart_product_sales: DataFrame,
    mart_daily_sales: DataFrame,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
) -> dict[str, object]:
    """The bundle as one nested object, its queries run side by side."""
    span = analytics.resolve_range(start, end)
    with shared_bundle(mart_product_sales, mart_daily_sales, span, limit) as frames:
        with ThreadPoolExecutor(len(frames)) as pool:
            found = dict(zip(frames, pool.map(_objects, frames.values())))
    summary = found["summary"][0]
    refunds = found["refund_summary"][0]
    return {
        "meta": {
            "from": span.start.isoformat(),
            "to": span.end.isoformat(),
            "defaultRangeDays": DEFAULT_RANGE_DAYS,
            "source": "gold",
        },
        "summary": summary,
        "revenueOverTime": found["revenue_over_time"],
        "topProducts": found["top_products"],
        "portfolio": {
            **found["portfolio_concentration"][0],
            "buckets": found["portfolio_buckets"],
        },
        "reimbursements": {
            "refundCents": refunds["refundCents"],
            "refundedOrderCount": refunds["refundedOrderCount"],
            "refundRate": refunds["refundRate"],
            "overTime": found["refunds_over_time"],
            "byProduct": found["refunds_by_product"],
        },
    }
