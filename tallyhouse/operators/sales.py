"""Sales at day and at day x product grain, with refunds spread over order lines.

Nothing here gathers the lines of one order into one task. Order totals are
plain sums, which Spark combines before the shuffle, and only lines of refunded
orders meet their refund, in a join whose hot partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import (
    allocated_share,
    count_if,
    ratio,
    total,
    totals,
)
from tallyhouse.operators.joins import join_grouped

# Line columns that simply add up, and their names in the marts.
LINE_MEASURES = {
    "quantity": "units_sold",
    "line_total_cents": "gross_revenue_cents",
    "discount_cents": "discount_cents",
    "cogs_cents": "cogs_cents",
    "gross_margin_cents": "gross_margin_cents",
}


def order_refunds(fct_refunds: DataFrame) -> DataFrame:
    """Completed refunds per order."""
    return (
        fct_refunds.where("is_completed")
        .groupBy("order_id")
        .agg(F.sum("refund_cents").cast("long").alias("refund_cents"))
    )


def daily_orders(fct_orders: DataFrame, fct_refunds: DataFrame) -> DataFrame:
    """Revenue orders per day; refunds count on the day of the order.

    Order money is summed straight from the scan. Only the refunded orders are
    joined back to orders, so the wide order rows are never shuffled.
    """
    revenue = fct_orders.where("is_revenue_order")
    money = revenue.groupBy("order_date").agg(
        F.count("*").alias("order_count"),
        F.sum("total_cents").alias("gmv_cents"),
        F.sum("subtotal_cents").alias("subtotal_cents"),
        F.sum("discount_cents").alias("discount_cents"),
        F.sum("shipping_cents").alias("shipping_cents"),
        F.sum("tax_cents").alias("tax_cents"),
    )
    # order_refunds has one row per order, so counting its rows counts orders.
    returned = (
        revenue.select("order_id", "order_date")
        .join(order_refunds(fct_refunds), "order_id")
        .groupBy("order_date")
        .agg(
            F.sum("refund_cents").alias("refund_cents"),
            count_if("refund_cents > 0", "refunded_order_count"),
        )
    )
    return money.join(returned, "order_date", "left").na.fill(
        0, ["refund_cents", "refunded_order_count"]
    )


def daily_reviews(fct_reviews: DataFrame) -> DataFrame:
    return fct_reviews.groupBy(F.col("review_date").alias("order_date")).agg(
        F.count("*").alias("review_count"), F.avg("rating").alias("avg_rating")
    )


def daily_counts(fct_orders: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """Revenue orders and reviews per day, for requests that need no more of a day."""
    orders = (
        fct_orders.where("is_revenue_order")
        .groupBy("order_date")
        .agg(F.count("*").alias("order_count"))
    )
    return orders.join(daily_reviews(fct_reviews), "order_date", "left").na.fill(
        0, ["review_count"]
    )


def mart_daily_sales(
    fct_orders: DataFrame, fct_refunds: DataFrame, fct_reviews: DataFrame
) -> DataFrame:
    """One row per day with revenue orders."""
    return (
        daily_orders(fct_orders, fct_refunds)
        .join(daily_reviews(fct_reviews), "order_date", "left")
        .select(
            "order_date",
            "order_count",
            "gmv_cents",
            (F.col("gmv_cents") - F.col("refund_cents")).alias("net_revenue_cents"),
            "refund_cents",
            "refunded_order_count",
            "subtotal_cents",
            "discount_cents",
            "shipping_cents",
            "tax_cents",
            F.expr(ratio("gmv_cents", "order_count")).alias("aov_cents"),
            F.expr(ratio("refund_cents", "gmv_cents", "0")).alias("refund_rate"),
            F.coalesce("review_count", F.lit(0).cast("long")).alias("review_count"),
            "avg_rating",
        )
    )


def order_line_totals(revenue_lines: DataFrame) -> DataFrame:
    """Line total per order, over the given lines."""
    return revenue_lines.groupBy("order_id").agg(
        F.sum("line_total_cents").cast("long").alias("order_lines_cents")
    )


REFUNDED_LINE = ["order_item_id", "order_id", "order_date", "product_id", "variant_id", "line_total_cents"]


def line_refunds(
    fct_order_items: DataFrame, fct_refunds: DataFrame, columns: Sequence[str] = REFUNDED_LINE
) -> DataFrame:
    """Revenue lines of refunded orders, with the given columns and their share of the refund.

    Orders without a refund need no share, so they drop out in an inner join,
    which Spark can also prune with a runtime filter before the shuffle.
    """
    lines = fct_order_items.where("is_revenue_order").select(*columns)
    refunded = order_refunds(fct_refunds).where("refund_cents > 0").withColumnRenamed(
        "refund_cents", "order_refund_cents"
    )
    order_totals = order_line_totals(lines).join(refunded, "order_id")
    return join_grouped(lines, order_totals, "order_id").select(
        *lines.columns,
        "order_refund_cents",
        "order_lines_cents",
        F.expr(
            allocated_share("order_refund_cents", "line_total_cents", "order_lines_cents")
        ).alias("refund_cents"),
    )


def _sold(
    lines: DataFrame, keys: list[str], distinct: dict[str, str], shares: DataFrame | None = None
) -> DataFrame:
    """Sums of the lines (and their refund shares) by ``keys``, and counts of distinct other keys.

    Two distinct counts in one aggregate would make Spark copy every line for each. Here
    each counted key has an aggregate of its own. The sums go with the first one, where
    they combine in the map tasks, and with them the lines that have the other keys; what
    these counted twice, found by a shuffle of keys alone, is taken off. The results are
    stacked and added up, so null keys stay and no join is needed.
    """
    measures = [F.expr(f"{total(line)} as {mart}") for line, mart in LINE_MEASURES.items()]
    if shares is None and len(distinct) < 2:
        counts = [F.count_distinct(key).alias(name) for key, name in distinct.items()]
        return lines.groupBy(*keys).agg(*counts, *measures)
    (first, first_count), *others = distinct.items()
    with_key = [F.count(key).alias(name) for key, name in others]
    stacked = lines.groupBy(*keys, first).agg(*measures, *with_key).select(
        *keys,
        F.expr(f"if({first} is null, 0L, 1L) as {first_count}"),
        *[name for _, name in others],
        *LINE_MEASURES.values(),
    )
    for key, name in others:
        repeated = lines.where(F.col(key).isNotNull()).groupBy(*keys, key).agg((1 - F.count("*")).alias(name))
        repeated = repeated.where(F.col(name) < 0).select(*keys, name)
        stacked = stacked.unionByName(repeated, allowMissingColumns=True)
    added = [*distinct.values(), *LINE_MEASURES.values()]
    if shares is not None:
        stacked = stacked.unionByName(shares.select(*keys, "refund_cents"), allowMissingColumns=True)
        added.append("refund_cents")
    return stacked.groupBy(*keys).agg(*totals(added))


def sales_by(
    lines: DataFrame,
    shares: DataFrame,
    *grain: str,
    label: str | None = None,
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """Roll revenue lines and their refund shares up to ``grain``.

    The two sides are summed apart and meet at the grain: both sums are combined
    in the map tasks, both end up hashed by the grain, and lines without a
    refund are never shuffled by order. ``distinct`` maps counted keys to the
    names of their counts, the key with fewest values in a group first.
    ``label`` is a text the grain determines; it is grouped by, since an
    aggregate of text would turn the hash aggregation into a sort of all lines.
    Shares of ``lines`` that carry the label are stacked with the counts: sums hashed by
    grain and label would be shuffled once more to meet others hashed by the grain.
    """
    keys = [*grain, *([label] if label else [])]
    if distinct and label in shares.columns:
        # As in a join, nothing is refunded where a part of the grain is missing.
        known = " and ".join(f"{key} is not null" for key in grain)
        sold = _sold(lines, keys, distinct, shares).withColumn(
            "refund_cents", F.expr(f"if({known}, refund_cents, 0L)")
        )
    else:
        refunded = shares.groupBy(*grain).agg(*totals(["refund_cents"]))
        sold = _sold(lines, keys, distinct or {}).join(refunded, list(grain), "left").na.fill(0, ["refund_cents"])
    return sold.selectExpr(
        "*",
        "gross_revenue_cents - refund_cents as net_revenue_cents",
        f"{ratio('gross_margin_cents', 'gross_revenue_cents')} as gross_margin_pct",
    )


def sold_lines(fct_order_items: DataFrame, *keys: str) -> DataFrame:
    """What the sales marts read of revenue lines: some keys and the measures."""
    own = ["order_id", "order_date", *keys, *LINE_MEASURES, "is_revenue_order"]
    return fct_order_items.where("is_revenue_order").select(*own)


def mart_product_sales(fct_order_items: DataFrame, fct_refunds: DataFrame) -> DataFrame:
    """One row per day and product with revenue lines."""
    return sales_by(
        fct_order_items.where("is_revenue_order"),
        line_refunds(
            fct_order_items,
            fct_refunds,
            ["order_id", "order_date", "product_id", "product_name", "line_total_cents"],
        ),
        "order_date",
        "product_id",
        label="product_name",
        distinct={"variant_id": "sku_count", "order_id": "order_count"},
    )
