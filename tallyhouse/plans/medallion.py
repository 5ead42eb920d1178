"""The pipeline's tables, what each reads, and lazy access to all of them.

A frame is only built when asked for, and Spark only computes what the final
query needs of it. ``plans.refresh`` writes the same tables layer by layer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tallyhouse.operators import categories, dimensions, facts, marts, periods, sales
from tallyhouse.operators.joins import joined_in_parts


class Tables(Protocol):
    """Anything that hands out tables by name."""

    def table(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class Model:
    """A table, the function that makes it, and that function's arguments in order."""

    make: Callable[..., DataFrame]
    below: tuple[str, ...] = ()  # tables of the layer below
    beside: tuple[str, ...] = ()  # tables of the same layer, listed earlier
    month_of: str | None = None  # date column whose month partitions the written table
    # What is needed of tables of the layer below that the function reads several times.
    again: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    # Columns of its tables on which rows meet, first of the table whose rows are counted: rows with
    # other values have nothing to do with each other, so the table can be written in parts.
    by: dict[str, str] = field(default_factory=dict)


SILVER_MODELS = {
    "dim_categories": Model(dimensions.categories, ("categories",)),
    "dim_customers": Model(dimensions.customers, ("customers", "customer_addresses")),
    "dim_dates": Model(dimensions.dates, ("orders",)),
    "dim_products": Model(dimensions.products, ("products",)),
    "dim_variants": Model(dimensions.variants, ("product_variants",), ("dim_products",)),
    "dim_variant_numbers": Model(periods.variant_numbers, (), ("dim_variants",)),
    "dim_payment_methods": Model(dimensions.payment_methods, ("payment_methods",)),
    "dim_warehouses": Model(dimensions.warehouses, ("warehouses",)),
    "fct_orders": Model(facts.orders, ("orders",), month_of="order_date"),
    "fct_order_items": Model(
        facts.order_items,
        ("order_items",),
        ("fct_orders", "dim_variants"),
        month_of="order_date",
        by={"order_items": "order_id", "fct_orders": "order_id"},
    ),
    "fct_payments": Model(
        facts.payments,
        ("payments",),
        ("fct_orders",),
        month_of="order_date",
        by={"payments": "order_id", "fct_orders": "order_id"},
    ),
    "fct_refunds": Model(
        facts.refunds,
        ("refunds",),
        ("fct_payments",),
        month_of="order_date",
        by={"refunds": "payment_id", "fct_payments": "payment_id"},
    ),
    "fct_shipments": Model(
        facts.shipments,
        ("shipments",),
        ("fct_orders",),
        month_of="order_date",
        by={"shipments": "order_id", "fct_orders": "order_id"},
    ),
    "fct_carts": Model(
        facts.carts,
        ("carts", "cart_items"),
        ("fct_orders",),
        month_of="cart_date",
        by={"carts": "id", "cart_items": "cart_id", "fct_orders": "cart_id"},
    ),
    "fct_inventory": Model(facts.inventory, ("inventory_levels",)),
    "fct_reviews": Model(facts.reviews, ("product_reviews",), month_of="review_date"),
    "fct_returns": Model(
        facts.returns,
        ("returns",),
        ("fct_orders",),
        month_of="order_date",
        by={"returns": "order_id", "fct_orders": "order_id"},
    ),
    "dim_enriched_products": Model(
        lambda brands, links, products, categories: dimensions.enriched_products(
            products, brands, categories, links
        ),
        ("brands", "product_categories"),
        ("dim_products", "dim_categories"),
    ),
    "dim_category_paths": Model(categories.category_paths, (), ("dim_categories",)),
    "dim_category_closure": Model(categories.category_closure, (), ("dim_categories",)),
    "dim_product_categories": Model(dimensions.product_categories, ("product_categories",)),
}



def _lines(*keys: str) -> dict[str, Callable[[DataFrame], DataFrame]]:
    return {"fct_order_items": lambda lines: sales.sold_lines(lines, *keys)}


# The two marts the product requests read.
REQUEST_MARTS = {
    "mart_daily_sales": Model(
        sales.mart_daily_sales, ("fct_orders", "fct_refunds", "fct_reviews"), month_of="order_date"
    ),
    "mart_product_sales": Model(
        sales.mart_product_sales,
        ("fct_order_items", "fct_refunds"),
        month_of="order_date",
        again=_lines("product_id", "product_name", "variant_id"),
    ),
}

DELIVERY_HOURS = 168  # promised from the order to the delivery

FURTHER_MARTS = {
    "mart_orders_by_status": Model(
        marts.orders_by_status, ("fct_orders",), month_of="order_date"
    ),
    "mart_variant_sales": Model(
        marts.variant_sales,
        ("fct_order_items", "fct_refunds"),
        month_of="order_date",
        again=_lines("variant_id", "sku"),
    ),
    "mart_sold_variants": Model(
        periods.sold_variants, ("fct_order_items", "dim_variant_numbers"), month_of="order_date"
    ),
    "mart_category_sales": Model(
        lambda products, sold: marts.category_sales(sold, products),
        ("dim_enriched_products",),
        ("mart_product_sales",),
        month_of="order_date",
    ),
    "mart_category_tree_sales": Model(
        lambda links, closure, sold: categories.category_tree_sales(
            sold, links, closure, marts.PRODUCT_MEASURES
        ),
        ("dim_product_categories", "dim_category_closure"),
        ("mart_product_sales",),
        month_of="order_date",
    ),
    "mart_brand_sales": Model(
        lambda products, sold: marts.brand_sales(sold, products),
        ("dim_enriched_products",),
        ("mart_product_sales",),
        month_of="order_date",
    ),
    "mart_fulfillment": Model(
        lambda shipments: marts.fulfillment(shipments, DELIVERY_HOURS),
        ("fct_shipments",),
        month_of="order_date",
    ),
    "mart_funnel_daily": Model(marts.funnel_daily, ("fct_carts",), month_of="cart_date"),
    "mart_customer_months": Model(
        marts.customer_months, ("fct_orders",), month_of="order_date"
    ),
    "mart_customer_activity": Model(marts.customer_activity, ("fct_orders",)),
    "mart_customer_cohorts": Model(marts.customer_cohorts, ("fct_orders",)),
    "mart_customer_ltv": Model(marts.customer_ltv, ("fct_orders",)),
    "mart_orders_per_customer": Model(
        marts.orders_per_customer, (), ("mart_customer_ltv",)
    ),
    "mart_geo_sales": Model(marts.geo_sales, ("fct_orders", "dim_customers")),
    "mart_rating_distribution": Model(marts.rating_distribution, ("fct_reviews",)),
    "mart_rating_by_week": Model(marts.rating_by_week, ("fct_reviews",)),
    "mart_payment_mix": Model(marts.payment_mix, ("fct_payments", "dim_payment_methods")),
    "mart_payment_success": Model(marts.payment_success, ("fct_payments",)),
    "mart_stockouts": Model(
        marts.stockouts, ("fct_inventory", "dim_variants", "dim_warehouses")
    ),
    "mart_stock_by_warehouse": Model(
        marts.stock_by_warehouse, ("fct_inventory", "dim_warehouses")
    ),
    "mart_refunds_by_day": Model(marts.refunds_by_day, ("fct_refunds",)),
    "mart_return_reasons": Model(marts.return_reasons, ("fct_returns",)),
}

GOLD_MODELS = {**REQUEST_MARTS, **FURTHER_MARTS}


class Layer:
    """Tables of one layer: the written one where there is one, else the lazy one."""

    def __init__(self, models: dict[str, Model], below: Tables):
        self.models = models
        self.below = below
        self._known: dict[str, DataFrame] = {}

    def build(self, name: str) -> DataFrame:
        model = self.models[name]
        inputs = [self.below.table(source) for source in model.below]
        return model.make(*inputs, *[self.table(sibling) for sibling in model.beside])

    def parts(self, name: str) -> list[DataFrame]:
        """``build``'s rows in frames for writes one after the other: one, unless they are many."""
        model = self.models[name]
        if not model.by:
            return [self.build(name)]
        inputs = {source: self.below.table(source) for source in model.below}
        inputs |= {sibling: self.table(sibling) for sibling in model.beside}
        cuts = joined_in_parts([(inputs[source], key) for source, key in model.by.items()])
        return [model.make(*(inputs | dict(zip(model.by, cut))).values()) for cut in cuts]

    @contextmanager
    def made(self, name: str) -> Iterator[DataFrame]:
        """``build``'s frame for one write.

        What a model reads several times of a table that is not written is made once, and
        kept on the executors' disks until the write is done: each reading would join and
        shuffle its rows anew. On disk it takes no memory from the joins.
        """
        model, kept = self.models[name], {}
        if isinstance(self.below, Layer):
            for source, needed in model.again.items():
                kept[source] = needed(self.below.table(source)).persist(StorageLevel.DISK_ONLY)
        try:
            inputs = [kept[source] if source in kept else self.below.table(source) for source in model.below]
            yield model.make(*inputs, *[self.table(sibling) for sibling in model.beside])
        finally:
            for frame in kept.values():
                frame.unpersist()

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self.build(name)
        return self._known[name]

    def use_written(self, name: str, frame: DataFrame) -> None:
        """From here on, hand out and build upon the written table."""
        self._known[name] = frame


def silver_over(bronze: Tables) -> Layer:
    return Layer(SILVER_MODELS, bronze)


def gold_over(silver: Tables) -> Layer:
    return Layer(GOLD_MODELS, silver)
