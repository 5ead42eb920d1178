"""The same three requests answered from silver, or from gold.

Over lazy silver tables (``silver_over(bronze)``) the first is the bronze path:
cleaning, joins and refund allocation run within the request. Over written
silver only the allocation and the roll-up do. The gold path reads the marts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import total
from tallyhouse.operators import analytics, sales
from tallyhouse.operators.analytics import DateRange
from tallyhouse.plans.medallion import Tables


class SilverRequests:
    """Answers from silver: allocation and roll-up run within the request.

    An order's lines and refunds carry its date, so the range filters all of
    them before anything is joined.
    """

    def __init__(self, silver: Tables, span: DateRange, limit: int | None = None):
        self.span = span
        self.limit = limit
        self._items = analytics.within(silver.table("fct_order_items"), span)
        self._refunds = analytics.within(silver.table("fct_refunds"), span)
        self._silver = silver

    def _sales_by(self, grain: str) -> DataFrame:
        lines = self._items.where("is_revenue_order")
        return sales.sales_by(lines, sales.line_refunds(self._items, self._refunds), grain)

    def _daily(self) -> DataFrame:
        orders = analytics.within(self._silver.table("fct_orders"), self.span)
        reviews = self._silver.table("fct_reviews").where(
            F.col("review_date").between(self.span.start, self.span.end)
        )
        return sales.daily_counts(orders, reviews)

    def summary(self) -> DataFrame:
        return analytics.summary(self._sales_by("product_id"), self._daily(), self.span)

    def revenue_over_time(self) -> DataFrame:
        return analytics.revenue_over_time(self._sales_by("order_date"), self._daily(), self.span)

    def top_products(self) -> DataFrame:
        days = sales.mart_product_sales(self._items, self._refunds)
        # Straight from the lines, so that the roll-up is not made twice.
        lines = self._items.where("is_revenue_order")
        gross = lines.agg(F.expr(total("line_total_cents")))
        return analytics.top_products(days, self.limit, gross)


class GoldRequests:
    """Answers from the two marts."""

    def __init__(self, gold: Tables, span: DateRange, limit: int | None = None):
        self.span = span
        self.limit = limit
        self._days = analytics.product_days(gold.table("mart_product_sales"), span)
        self._daily = gold.table("mart_daily_sales")

    def summary(self) -> DataFrame:
        return analytics.summary(self._days, self._daily, self.span)

    def revenue_over_time(self) -> DataFrame:
        return analytics.revenue_over_time(self._days, self._daily, self.span)

    def top_products(self) -> DataFrame:
        return analytics.top_products(self._days, self.limit)


Requests = SilverRequests | GoldRequests

CONTROL_TOTALS = ["gross_revenue_cents", "net_revenue_cents", "refund_cents", "cogs_cents"]


def reconciliation(bronze_path: Requests, silver_path: Requests, gold_path: Requests) -> DataFrame:
    """Control totals per layer, and whether each equals the gold ones."""
    gold_totals = gold_path.summary().select(F.struct(*CONTROL_TOTALS).alias("control"))
    rows = [
        path.summary().select(F.lit(layer).alias("layer"), *CONTROL_TOTALS)
        for layer, path in (("bronze", bronze_path), ("silver", silver_path), ("gold", gold_path))
    ]
    stacked = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return stacked.withColumn(
        "agrees", F.struct(*CONTROL_TOTALS) == gold_totals.scalar()
    )

