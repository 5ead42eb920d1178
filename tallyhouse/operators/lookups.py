"""Lookups, candidate lists and completeness reports over the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import slug
from tallyhouse.operators.facts import REVENUE_STATUSES

# Payment states a refund can be paid from.
REFUNDABLE_PAYMENTS = ("succeeded", "refunded")


def missing_stock_rows(
    warehouses: DataFrame, variants: DataFrame, inventory_levels: DataFrame
) -> DataFrame:
    """Per variant and per warehouse how many stock rows there should be, are and lack.

    A variant should have a row in each warehouse. Pairs are counted, never made: the
    counts need the stock rows and the number of variants and warehouses only.
    """
    pairs = (
        inventory_levels.select("variant_id", "warehouse_id")
        .join(variants.select(F.col("id").alias("variant_id")), "variant_id", "left_semi")
        .join(warehouses.select(F.col("id").alias("warehouse_id")), "warehouse_id", "left_semi")
        .distinct()
    )

    def side(name: str, own: DataFrame, other: DataFrame) -> DataFrame:
        present = pairs.groupBy(F.col(f"{name}_id").alias("id")).agg(F.count("*").alias("n"))
        expected = other.select(F.count("*").alias("n")).scalar()
        return (
            own.select("id")
            .join(present, "id", "left")
            .select(
                F.lit(name).alias("side"),
                F.col("id").cast("string").alias("id"),
                expected.alias("expected_rows"),
                F.coalesce("n", F.lit(0).cast("long")).alias("present_rows"),
            )
            .withColumn("missing_rows", F.col("expected_rows") - F.col("present_rows"))
        )

    return side("variant", variants, warehouses).union(side("warehouse", warehouses, variants))


def refund_candidates(
    orders: DataFrame, order_items: DataFrame, payments: DataFrame
) -> DataFrame:
    """Lines of revenue orders with the payment a refund could go to, if any."""
    sold = orders.where(F.col("status").isin(*REVENUE_STATUSES)).select(
        F.col("id").alias("order_id"), "customer_id", "placed_at"
    )
    lines = order_items.select(F.col("id").alias("order_item_id"), "order_id", "quantity")
    # The condition on the payment is part of the join: lines without one stay.
    refundable = payments.where(F.col("status").isin(*REFUNDABLE_PAYMENTS)).select(
        F.col("id").alias("payment_id"), "order_id", "amount_cents"
    )
    return sold.join(lines, "order_id").join(refundable, "order_id", "left")


def review_candidates(
    orders: DataFrame, order_items: DataFrame, variants: DataFrame, products: DataFrame
) -> DataFrame:
    """Who bought which product in a revenue order, one row per order line."""
    sold = orders.where(F.col("status").isin(*REVENUE_STATUSES)).select(
        F.col("id").alias("order_id"), "customer_id", "placed_at"
    )
    known = products.select(F.col("id").alias("product_id"))
    goods = variants.select(F.col("id").alias("variant_id"), "product_id").join(
        known, "product_id", "left_semi"
    )
    lines = order_items.select(F.col("id").alias("order_item_id"), "order_id", "variant_id")
    return sold.join(lines, "order_id").join(goods, "variant_id").drop("variant_id")


def random_rows(frame: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """A random sample of ``count`` rows that is the same on every run of a seed.

    The order comes from a digest of the row key, not from a generator that
    depends on partitions, so a rerun after a lost executor picks the same rows.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return frame.orderBy(digest, key).limit(count)


def variant_lookup(variants: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    return variants.join(names, "product_id").select("id", "price_cents", "sku", "product_name")


def leaf_categories(categories: DataFrame) -> DataFrame:
    return categories.where("parent_id is not null").select("id")


def active_coupons(coupons: DataFrame) -> DataFrame:
    return coupons.where("is_active").select("id", "discount_type", "discount_value")


def completeness(
    counted: dict[str, DataFrame], expected: dict[str, Column]
) -> DataFrame:
    """Rows expected, present and missing per table.

    ``expected`` may use the row count of any counted table by the table's name.
    """
    counts = {
        name: frame.agg(F.count("*").alias("n")).scalar() for name, frame in counted.items()
    }
    some_table = next(iter(counted.values()))
    one_row = some_table.agg(F.count("*").alias("_rows")).select(
        *[count.alias(name) for name, count in counts.items()]
    )
    lines = [
        F.struct(
            F.lit(name).alias("table_name"),
            rows.cast("long").alias("expected_rows"),
            F.col(name).alias("actual_rows"),
        )
        for name, rows in expected.items()
    ]
    return (
        one_row.select(F.explode(F.array(*lines)).alias("line"))
        .select("line.*")
        .withColumn(
            "missing_rows",
            F.greatest(F.col("expected_rows") - F.col("actual_rows"), F.lit(0).cast("long")),
        )
    )


def product_slugs(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), slug("name").alias("name_slug"))


def addresses_by_customer(addresses: DataFrame) -> DataFrame:
    """One row per customer and address, however many a customer has."""
    return addresses.select("customer_id", F.col("id").alias("address_id"))
