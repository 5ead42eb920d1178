"""Which checks run on which table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import facts, quality
from tallyhouse.plans.medallion import Tables

# Keys, required columns and enumerations of the written tables.
SILVER_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id", "product_slug"],
    "dim_variants": ["variant_id"],
    "dim_categories": ["category_id"],
    "dim_dates": ["date_day"],
    "fct_orders": ["order_id"],
    "fct_order_items": ["order_item_id"],
    "fct_payments": ["payment_id"],
    "fct_shipments": ["shipment_id"],
    "fct_refunds": ["refund_id"],
    "fct_carts": ["cart_id"],
    "fct_reviews": ["review_id"],
}
SILVER_REQUIRED = {
    **SILVER_KEYS,
    "dim_variants": ["variant_id", "sku", "product_id"],
    "fct_orders": ["order_id", "customer_id"],
    "fct_order_items": ["order_item_id", "order_id", "variant_id"],
    "fct_refunds": ["refund_id", "payment_id"],
    "fct_inventory": ["warehouse_id", "variant_id"],
    "fct_reviews": ["review_id", "rating"],
}
ORDER_STATUSES = ["pending", "paid", "fulfilled", "cancelled", "refunded"]
PAYMENT_STATUSES = ["pending", "succeeded", "refunded", "failed"]
RATINGS = [1, 2, 3, 4, 5]
NATURAL_KEYS = [
    ("orders", "order_number"),
    ("product_variants", "sku"),
    ("products", "slug"),
    ("categories", "slug"),
    ("brands", "slug"),
    ("coupons", "code"),
    ("coupon_redemptions", "order_id"),
    ("users", "email"),
]
EMAIL = "^[^@ ]+@[^@ ]+[.][^@ ]+$"


def uniqueness(silver: Tables, gold: Tables) -> DataFrame:
    checks = [
        quality.unique(silver.table(table), f"silver_{table}", column)
        for table, columns in SILVER_KEYS.items()
        for column in columns
    ]
    checks.append(
        quality.unique(gold.table("mart_daily_sales"), "gold_mart_daily_sales", "order_date")
    )
    checks.append(
        quality.unique(
            gold.table("mart_product_sales"), "gold_mart_product_sales", "order_date", "product_id"
        )
    )
    return quality.all_of(checks)


def required(silver: Tables, gold: Tables) -> DataFrame:
    checks = [
        quality.not_null(silver.table(table), f"silver_{table}", *columns)
        for table, columns in SILVER_REQUIRED.items()
    ]
    for mart, columns in (
        ("mart_daily_sales", ["order_date"]),
        ("mart_product_sales", ["order_date", "product_id"]),
    ):
        checks.append(quality.not_null(gold.table(mart), f"gold_{mart}", *columns))
    return quality.all_of(checks)


def foreign_keys(bronze: Tables, silver: Tables) -> DataFrame:
    links = [
        ("dim_variants", "product_id", "dim_products"),
        ("fct_order_items", "order_id", "fct_orders"),
        ("fct_order_items", "variant_id", "dim_variants"),
    ]
    checks = [
        quality.relationships(
            silver.table(child), f"silver_{child}", column, silver.table(parent), column
        )
        for child, column, parent in links
    ]
    # The same at the source, where nothing has been filtered out yet.
    for child, column, parent in (
        ("refunds", "payment_id", "payments"),
        ("product_reviews", "product_id", "products"),
        ("order_items", "variant_id", "product_variants"),
    ):
        checks.append(
            quality.relationships(
                bronze.table(child), f"bronze_{child}", column, bronze.table(parent), "id"
            )
        )
    return quality.all_of(checks)


def enumerations(silver: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.accepted_values(
                silver.table("fct_orders"), "silver_fct_orders", "order_status", ORDER_STATUSES
            ),
            quality.accepted_values(
                silver.table("fct_payments"),
                "silver_fct_payments",
                "payment_status",
                PAYMENT_STATUSES,
                quality.WARN,
            ),
            quality.accepted_values(
                silver.table("fct_reviews"), "silver_fct_reviews", "rating", RATINGS
            ),
        ]
    )


def rating_range(bronze: Tables) -> DataFrame:
    return quality.holds(
        bronze.table("product_reviews"),
        "bronze_product_reviews",
        "rating",
        "between_1_and_5",
        F.col("rating").between(RATINGS[0], RATINGS[-1]),
    )


def composite_keys(bronze: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.unique(
                bronze.table("cart_items"), "bronze_cart_items", "cart_id", "variant_id"
            ),
            quality.unique(
                bronze.table("inventory_levels"),
                "bronze_inventory_levels",
                "warehouse_id",
                "variant_id",
            ),
        ]
    )


def natural_keys(bronze: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.unique(bronze.table(table), f"bronze_{table}", column)
            for table, column in NATURAL_KEYS
        ]
    )


def soft_rules(bronze: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.holds(
                bronze.table("users"),
                "bronze_users",
                "email",
                "looks_like_email",
                F.col("email").rlike(EMAIL),
                quality.WARN,
            ),
            quality.holds(
                bronze.table("product_reviews"),
                "bronze_product_reviews",
                "rating",
                "between_1_and_5",
                F.col("rating").between(RATINGS[0], RATINGS[-1]),
                quality.WARN,
            ),
            *[
                quality.holds(
                    bronze.table(table),
                    f"bronze_{table}",
                    "quantity",
                    "positive",
                    F.col("quantity") > 0,
                    quality.WARN,
                )
                for table in ("order_items", "cart_items", "return_items")
            ],
        ]
    )


def dropped_rows(bronze: Tables) -> DataFrame:
    """How many source rows each silver filter leaves out by itself."""
    paid_in = F.col("amount_cents") >= 0
    filters = [
        ("orders", "valid_order", facts.valid_order()),
        ("order_items", "valid_line", facts.valid_line()),
        ("payments", "not_negative", paid_in),
        ("refunds", "not_negative", paid_in),
        ("inventory_levels", "valid_stock", facts.valid_stock()),
        ("product_reviews", "valid_rating", facts.valid_rating()),
    ]
    return quality.all_of(
        [
            quality.dropped(bronze.table(table), f"bronze_{table}", name, rule)
            for table, name, rule in filters
        ]
    )
