"""Silver facts: one clean row per business event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import (
    blank_to_null,
    clean_lower,
    clean_upper,
    hours_crossed,
    ratio,
)

# Raw order statuses whose orders count as revenue.
REVENUE_STATUSES = ("paid", "fulfilled", "refunded")

ORDER_MONEY = ["subtotal_cents", "discount_cents", "shipping_cents", "tax_cents", "total_cents"]


def _has_status(value: str) -> Column:
    """Flags look at the status as delivered, not at the cleaned one."""
    return F.col("status") == value


def valid_order() -> Column:
    return (
        F.col("customer_id").isNotNull()
        & F.col("placed_at").isNotNull()
        & (F.col("total_cents") >= 0)
    )


def valid_line() -> Column:
    return (F.col("quantity") > 0) & (F.col("line_total_cents") >= 0)


def valid_rating() -> Column:
    return F.col("rating").between(1, 5)


def valid_stock() -> Column:
    return (F.col("quantity_on_hand") >= 0) & (F.col("quantity_reserved") >= 0)


def orders(source: DataFrame) -> DataFrame:
    return source.where(valid_order()).select(
        F.col("id").alias("order_id"),
        "order_number",
        "customer_id",
        "cart_id",
        clean_lower("status").alias("order_status"),
        clean_upper("currency_code").alias("currency_code"),
        *ORDER_MONEY,
        "shipping_address_id",
        "billing_address_id",
        "placed_at",
        F.to_date("placed_at").alias("order_date"),
        F.col("status").isin(*REVENUE_STATUSES).alias("is_revenue_order"),
        *[
            _has_status(value).alias(f"is_{value}")
            for value in ("cancelled", "refunded", "fulfilled")
        ],
        "created_at",
        "updated_at",
    )


def order_items(source: DataFrame, fct_orders: DataFrame, dim_variants: DataFrame) -> DataFrame:
    """Order lines of valid orders with cost and margin."""
    heads = fct_orders.select(
        "order_id", "customer_id", "order_date", "placed_at", "order_status", "is_revenue_order"
    )
    goods = dim_variants.select(
        "variant_id",
        "product_id",
        "product_name",
        "sku",
        F.col("cost_cents").alias("unit_cost_cents"),
    )
    cost = F.col("quantity").cast("long") * F.col("unit_cost_cents")
    return (
        source.where(valid_line())
        .withColumnRenamed("id", "order_item_id")
        .join(heads, "order_id")
        .join(goods, "variant_id")
        .withColumn("cogs_cents", cost)
        .withColumn("gross_margin_cents", F.col("line_total_cents") - F.col("cogs_cents"))
        .select(
            "order_item_id",
            "order_id",
            "customer_id",
            "order_date",
            "placed_at",
            "order_status",
            "is_revenue_order",
            "variant_id",
            "product_id",
            "product_name",
            "sku",
            F.coalesce(blank_to_null("product_name_snapshot"), "product_name").alias(
                "product_name_snapshot"
            ),
            clean_upper("sku_snapshot").alias("sku_snapshot"),
            "quantity",
            "unit_price_cents",
            "discount_cents",
            "tax_cents",
            "line_total_cents",
            "unit_cost_cents",
            "cogs_cents",
            "gross_margin_cents",
            F.expr(ratio("gross_margin_cents", "line_total_cents")).alias("gross_margin_pct"),
        )
    )


def payments(source: DataFrame, fct_orders: DataFrame) -> DataFrame:
    heads = fct_orders.select("order_id", "customer_id", "order_date")
    return (
        source.where("amount_cents >= 0")
        .join(heads, "order_id")
        .select(
            F.col("id").alias("payment_id"),
            "order_id",
            "customer_id",
            "order_date",
            "payment_method_id",
            "amount_cents",
            clean_lower("status").alias("payment_status"),
            *[
                _has_status(value).alias(f"is_{value}")
                for value in ("succeeded", "refunded", "pending")
            ],
            "provider_ref",
            "paid_at",
            F.to_date(F.coalesce("paid_at", "created_at")).alias("payment_date"),
            "created_at",
        )
    )


def refunds(source: DataFrame, fct_payments: DataFrame) -> DataFrame:
    paid = fct_payments.select("payment_id", "order_id", "customer_id", "order_date")
    return (
        source.where("amount_cents >= 0")
        .join(paid, "payment_id")
        .select(
            F.col("id").alias("refund_id"),
            "return_id",
            "payment_id",
            "order_id",
            "customer_id",
            "order_date",
            F.col("amount_cents").alias("refund_cents"),
            clean_lower("status").alias("refund_status"),
            _has_status("completed").alias("is_completed"),
            "refunded_at",
            F.to_date(F.coalesce("refunded_at", "created_at")).alias("refund_date"),
            "created_at",
        )
    )


def shipments(source: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Shipments with lead times; a missing instant makes its lead times null."""
    heads = fct_orders.select("order_id", "customer_id", "order_date", "placed_at")
    return source.join(heads, "order_id").select(
        F.col("id").alias("shipment_id"),
        "order_id",
        "customer_id",
        "order_date",
        "placed_at",
        "shipping_method_id",
        "warehouse_id",
        "tracking_number",
        clean_lower("status").alias("shipment_status"),
        _has_status("delivered").alias("is_delivered"),
        "shipped_at",
        "delivered_at",
        "created_at",
        hours_crossed("placed_at", "shipped_at").alias("hours_order_to_ship"),
        hours_crossed("shipped_at", "delivered_at").alias("hours_ship_to_deliver"),
        hours_crossed("placed_at", "delivered_at").alias("hours_order_to_deliver"),
    )


def carts(source: DataFrame, cart_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Carts with content and outcome; every cart without an order is abandoned."""
    content = cart_items.groupBy("cart_id").agg(
        F.sum("quantity").alias("item_quantity"),
        F.sum(F.col("quantity").cast("long") * F.col("unit_price_cents").cast("long")).alias("cart_value_cents"),
    )
    bought = fct_orders.where("cart_id is not null").select(
        "cart_id", F.col("order_id").alias("converted_order_id")
    )
    nothing = F.lit(0).cast("long")
    return (
        source.withColumnRenamed("id", "cart_id")
        .join(bought, "cart_id", "left")
        .join(content, "cart_id", "left")
        .select(
            "cart_id",
            "customer_id",
            clean_lower("status").alias("cart_status"),
            clean_upper("currency_code").alias("currency_code"),
            "created_at",
            "updated_at",
            F.to_date("created_at").alias("cart_date"),
            "converted_order_id",
            F.isnotnull("converted_order_id").alias("is_converted"),
            F.isnull("converted_order_id").alias("is_abandoned"),
            F.coalesce("item_quantity", nothing).alias("item_quantity"),
            F.coalesce("cart_value_cents", nothing).alias("cart_value_cents"),
        )
    )


def inventory(source: DataFrame) -> DataFrame:
    free = F.col("quantity_on_hand") - F.col("quantity_reserved")
    none_left = F.lit(0).cast("long")
    return source.where(valid_stock()).select(
        "warehouse_id",
        "variant_id",
        "quantity_on_hand",
        "quantity_reserved",
        F.greatest(free, none_left).alias("quantity_available"),
        "reorder_point",
        (F.col("quantity_on_hand") <= F.coalesce("reorder_point", none_left)).alias(
            "is_below_reorder_point"
        ),
        (free <= 0).alias("is_stockout"),
        "updated_at",
    )


def reviews(source: DataFrame) -> DataFrame:
    return source.where(valid_rating()).select(
        F.col("id").alias("review_id"),
        "product_id",
        "customer_id",
        "order_id",
        "rating",
        blank_to_null("title").alias("review_title"),
        blank_to_null("body").alias("review_body"),
        F.coalesce("is_verified_purchase", F.lit(False)).alias("is_verified_purchase"),
        "created_at",
        F.to_date("created_at").alias("review_date"),
        valid_rating().alias("is_valid_rating"),
    )


def returns(source: DataFrame, fct_orders: DataFrame) -> DataFrame:
    heads = fct_orders.select("order_id", "customer_id", "order_date")
    return source.join(heads, "order_id").select(
        F.col("id").alias("return_id"),
        "order_id",
        "customer_id",
        "order_date",
        clean_lower("status").alias("return_status"),
        blank_to_null("reason").alias("return_reason"),
        "requested_at",
        "resolved_at",
        F.to_date("requested_at").alias("return_date"),
        F.isnotnull("resolved_at").alias("is_resolved"),
    )
