"""Further marts: orders, products, customers, funnel, promotions, operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import count_if, ratio, total, totals
from tallyhouse.operators import sales
from tallyhouse.operators.analytics import DateRange, within

PRODUCT_MEASURES = [
    "units_sold",
    "gross_revenue_cents",
    "refund_cents",
    "net_revenue_cents",
    "discount_cents",
    "cogs_cents",
    "gross_margin_cents",
]
DAILY_MEASURES = [
    "order_count",
    "gmv_cents",
    "net_revenue_cents",
    "refund_cents",
    "refunded_order_count",
    "subtotal_cents",
    "discount_cents",
    "shipping_cents",
    "tax_cents",
    "review_count",
]


MARGIN = ratio("gross_margin_cents", "gross_revenue_cents")


# -- orders ---------------------------------------------------------------------


def orders_by_status(fct_orders: DataFrame) -> DataFrame:
    """Day x status: orders and their value."""
    return fct_orders.groupBy("order_date", "order_status").agg(
        F.count("*").alias("order_count"), F.expr(total("total_cents")).alias("gmv_cents")
    )


def orders_by_status_stacked(fct_orders: DataFrame, statuses: list[str]) -> DataFrame:
    """Order counts of a day: one column per given status, one for all others, and all."""
    status = F.col("order_status")
    unknown = ~F.coalesce(status.isin(*statuses), F.lit(False))
    return fct_orders.groupBy("order_date").agg(
        *(F.count_if(status == name).alias(name) for name in statuses),
        F.count_if(unknown).alias("other"),
        F.count("*").alias("order_count"),
    )


def overview(mart_daily_sales: DataFrame, span: DateRange | None = None) -> DataFrame:
    """Key figures of the range (or of all days) in one row."""
    days = within(mart_daily_sales, span) if span else mart_daily_sales
    return (
        days.agg(*totals(["gmv_cents", "net_revenue_cents", "refund_cents", "order_count"]))
        .withColumn("aov_cents", F.expr(ratio("gmv_cents", "order_count")))
        .withColumn("refund_rate", F.expr(ratio("refund_cents", "gmv_cents", "0")))
    )


# -- products -------------------------------------------------------------------


def variant_sales(fct_order_items: DataFrame, fct_refunds: DataFrame) -> DataFrame:
    """Day x variant."""
    return sales.sales_by(
        fct_order_items.where("is_revenue_order"),
        sales.line_refunds(
            fct_order_items, fct_refunds, ["order_id", "order_date", "variant_id", "sku", "line_total_cents"]
        ),
        "order_date",
        "variant_id",
        label="sku",
        distinct={"order_id": "order_count"},
    )


def top_skus(mart_variant_sales: DataFrame, span: DateRange, limit: int) -> DataFrame:
    """Best sold variants; a SKU that changed in the range does not split its variant."""
    order = [F.col("units_sold").desc(), F.col("variant_id").asc()]
    days = within(mart_variant_sales, span)
    sold = days.groupBy("variant_id").agg(*totals(["units_sold", "gross_revenue_cents"]))
    top = sold.orderBy(*order).limit(limit)
    skus = (
        days.join(top.select("variant_id"), "variant_id", "left_semi")
        .groupBy("variant_id")
        .agg(F.min("sku").alias("sku"))
    )
    return (
        top.join(skus, "variant_id")
        .select("variant_id", "sku", "units_sold", "gross_revenue_cents")
        .orderBy(*order)
    )


def _by_attribute(
    mart_product_sales: DataFrame, enriched_products: DataFrame, key: str, label: str
) -> DataFrame:
    """Day x attribute, from the mart: one row per day and product meets its attributes.

    Sales of a product that is no longer in the catalogue stay, without an attribute.
    """
    attributes = enriched_products.select("product_id", key, label)
    return (
        mart_product_sales.join(attributes, "product_id", "left")
        .groupBy("order_date", key, label)
        .agg(*totals(PRODUCT_MEASURES))
        .withColumn("gross_margin_pct", F.expr(MARGIN))
    )


def category_sales(mart_product_sales: DataFrame, enriched_products: DataFrame) -> DataFrame:
    """By primary category: a product in several categories counts once."""
    return _by_attribute(
        mart_product_sales, enriched_products, "primary_category_id", "category_path"
    )


def brand_sales(mart_product_sales: DataFrame, enriched_products: DataFrame) -> DataFrame:
    return _by_attribute(mart_product_sales, enriched_products, "brand_id", "brand_name")


def product_sales_with_names(
    mart_product_sales: DataFrame, enriched_products: DataFrame
) -> DataFrame:
    """The product mart with brand and category names."""
    names = enriched_products.select("product_id", "brand_name", "category_name", "category_path")
    return mart_product_sales.join(names, "product_id", "left")


def slow_movers(
    dim_products: DataFrame,
    mart_product_sales: DataFrame,
    as_of: dt.date,
    days: int = 90,
    limit: int | None = None,
) -> DataFrame:
    """Active products by units sold in the last ``days`` days, fewest first."""
    recent = within(mart_product_sales, DateRange(as_of - dt.timedelta(days=days - 1), as_of))
    sold = recent.groupBy("product_id").agg(*totals(["units_sold", "gross_revenue_cents"]))
    slowest = (
        dim_products.where("is_active")
        .select("product_id", "product_name")
        .join(sold, "product_id", "left")
        .na.fill(0, ["units_sold", "gross_revenue_cents"])
        .orderBy(F.col("units_sold").asc(), F.col("product_id").asc())
    )
    return slowest.limit(limit) if limit else slowest


# -- customers ------------------------------------------------------------------


def _customer_spans(fct_orders: DataFrame, unit: str) -> DataFrame:
    """Customer x day or month with revenue orders, and the customer's first one.

    Orders are summed up before the window, so that a customer's group holds as
    many rows as there are days or months, however many orders there are.
    """
    first = F.min("span").over(Window.partitionBy("customer_id"))
    return (
        fct_orders.where("is_revenue_order")
        .groupBy("customer_id", F.date_trunc(unit, "order_date").cast("date").alias("span"))
        .agg(F.count("*").alias("orders"), F.sum("total_cents").alias("cents"))
        .withColumn("first_span", first)
    )


def customer_activity(fct_orders: DataFrame) -> DataFrame:
    """Day: new and returning buyers, and first and repeat orders."""
    return (
        _customer_spans(fct_orders, "DAY")
        .groupBy(F.col("span").alias("order_date"))
        .agg(
            count_if("span = first_span", "new_buyers"),
            count_if("span > first_span", "returning_buyers"),
            F.expr(total("orders")).alias("order_count"),
        )
        .withColumn("new_customer_orders", F.col("new_buyers"))
        .withColumn("returning_customer_orders", F.col("order_count") - F.col("new_buyers"))
    )


def customer_cohorts(fct_orders: DataFrame) -> DataFrame:
    """Month of first order x months since: active customers and retention."""
    months = F.months_between("span", "first_span").cast("int")
    return with_retention(
        _customer_spans(fct_orders, "MONTH")
        .groupBy(F.col("first_span").alias("cohort_month"), months.alias("period_number"))
        .agg(F.count("*").alias("active_customers"))
    )


def customer_months(fct_orders: DataFrame) -> DataFrame:
    """Customer x month of revenue orders (``order_date`` is the month's first day).

    A month's rows follow from its orders alone, so the table is refreshed by month, and
    what is known of a customer follows from few rows.
    """
    return (
        fct_orders.where("is_revenue_order")
        .groupBy("customer_id", F.trunc("order_date", "MM").alias("month"))
        .agg(
            F.count("*").alias("order_count"),
            F.expr(total("total_cents")).alias("ltv_cents"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumnRenamed("month", "order_date")
    )


def ltv_of_months(mart_customer_months: DataFrame) -> DataFrame:
    """``customer_ltv`` from the months of customers."""
    return mart_customer_months.groupBy("customer_id").agg(
        *totals(["order_count", "ltv_cents"]),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )


def cohort_counts(mart_customer_months: DataFrame) -> DataFrame:
    """(cohort_month, period_number, active_customers) of the given customers' months.

    Counts of disjoint customers add up, so those of changed customers can be taken out
    of a table and put in again. The window holds the months of one customer.
    """
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    months = F.months_between("order_date", "cohort_month").cast("int")
    return (
        mart_customer_months.select("customer_id", "order_date", first.alias("cohort_month"))
        .groupBy("cohort_month", months.alias("period_number"))
        .agg(F.count("*").alias("active_customers"))
    )


def with_retention(counts: DataFrame) -> DataFrame:
    size = F.max(F.when(F.col("period_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return counts.withColumn("cohort_size", size).withColumn(
        "retention_pct", F.expr(ratio("active_customers", "cohort_size")) * 100
    )


def customer_ltv(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.where("is_revenue_order")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("order_count"),
            F.expr(total("total_cents")).alias("ltv_cents"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def top_customers(mart_customer_ltv: DataFrame, limit: int) -> DataFrame:
    return mart_customer_ltv.orderBy(
        F.col("ltv_cents").desc(), F.col("customer_id").asc()
    ).limit(limit)


def orders_per_customer(mart_customer_ltv: DataFrame) -> DataFrame:
    """Histogram: customers by number of orders."""
    return mart_customer_ltv.groupBy("order_count").agg(F.count("*").alias("customers"))


def geo_sales(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Region x customers, buyers among them, and value.

    Orders shrink to customers before the join. Customers without orders count, and
    orders of unknown customers stay, without a region.
    """
    places = dim_customers.select("customer_id", "default_country_code", "default_state")
    return (
        places.join(customer_ltv(fct_orders), "customer_id", "full")
        .groupBy("default_country_code", "default_state")
        .agg(
            F.count("*").alias("customers"),
            F.count("order_count").alias("buyers"),
            *totals(["order_count"]),
            F.expr(total("ltv_cents")).alias("gmv_cents"),
        )
    )


# -- funnel, promotions, reviews -------------------------------------------------


def funnel_daily(fct_carts: DataFrame) -> DataFrame:
    return (
        fct_carts.groupBy("cart_date")
        .agg(
            F.count("*").alias("carts_created"),
            count_if("item_quantity > 0", "carts_with_items"),
            count_if("is_converted", "orders"),
            count_if("is_abandoned", "abandoned_carts"),
        )
        .withColumn("abandoned_rate", F.expr(ratio("abandoned_carts", "carts_created")))
    )


def promo_performance(
    coupons: DataFrame, redemptions: DataFrame, fct_orders: DataFrame
) -> DataFrame:
    """Coupon: redemptions, discount given, value of the revenue orders it was used on.

    Redemptions are summed per coupon before they meet the coupons, so one
    coupon used by a third of all orders is no hot join key.
    """
    revenue = fct_orders.where("is_revenue_order").select("order_id", "total_cents")
    used = (
        redemptions.select("coupon_id", "order_id", "discount_cents")
        .join(revenue, "order_id", "left")
        .groupBy("coupon_id")
        .agg(
            F.count("*").alias("redemptions"),
            *totals(["discount_cents"]),
            F.expr(total("total_cents")).alias("influenced_gmv_cents"),
        )
    )
    return (
        coupons.select(
            F.col("id").alias("coupon_id"), F.col("code").alias("coupon_code"), "discount_type"
        )
        .join(used, "coupon_id", "left")
        .na.fill(0, ["redemptions", "discount_cents", "influenced_gmv_cents"])
    )


def rating_distribution(fct_reviews: DataFrame) -> DataFrame:
    return fct_reviews.groupBy("rating").agg(F.count("*").alias("review_count"))


def rating_by_week(fct_reviews: DataFrame) -> DataFrame:
    return fct_reviews.groupBy(
        F.date_trunc("WEEK", "review_date").cast("date").alias("week_start")
    ).agg(F.count("*").alias("review_count"), F.avg("rating").alias("avg_rating"))


# -- operations ------------------------------------------------------------------


def payment_mix(fct_payments: DataFrame, dim_payment_methods: DataFrame) -> DataFrame:
    by_method = fct_payments.groupBy("payment_method_id").agg(
        F.count("*").alias("payment_count"),
        count_if("is_succeeded", "succeeded_count"),
        *totals(["amount_cents"]),
    )
    return by_method.join(dim_payment_methods, "payment_method_id", "left")


def payment_success(fct_payments: DataFrame) -> DataFrame:
    return (
        fct_payments.groupBy("payment_date")
        .agg(
            F.count("*").alias("payment_count"),
            count_if("is_succeeded", "succeeded_count"),
        )
        .withColumn("success_rate", F.expr(ratio("succeeded_count", "payment_count")))
    )


def fulfillment(fct_shipments: DataFrame, sla_hours: int) -> DataFrame:
    """Order day: hours to ship, and deliveries within ``sla_hours`` of the order."""
    return (
        fct_shipments.groupBy("order_date")
        .agg(
            F.count("*").alias("shipment_count"),
            F.avg("hours_order_to_ship").alias("avg_hours_to_ship"),
            F.count("hours_order_to_deliver").alias("delivered_count"),
            count_if(f"hours_order_to_deliver <= {int(sla_hours)}", "on_time_count"),
        )
        .withColumn("on_time_pct", F.expr(ratio("on_time_count", "delivered_count")) * 100)
    )


def stockouts(
    fct_inventory: DataFrame, dim_variants: DataFrame, dim_warehouses: DataFrame
) -> DataFrame:
    """Variants a warehouse cannot sell any more; unknown variants and warehouses stay."""
    return (
        fct_inventory.where("is_stockout")
        .select("warehouse_id", "variant_id", "quantity_on_hand", "quantity_reserved")
        .join(dim_variants.select("variant_id", "sku", "product_name"), "variant_id", "left")
        .join(dim_warehouses.select("warehouse_id", "warehouse_code"), "warehouse_id", "left")
    )


def stock_by_warehouse(fct_inventory: DataFrame, dim_warehouses: DataFrame) -> DataFrame:
    stock = fct_inventory.groupBy("warehouse_id").agg(
        F.count("*").alias("variants"),
        *totals(["quantity_on_hand", "quantity_reserved", "quantity_available"]),
        count_if("is_stockout", "stockout_variants"),
        count_if("is_below_reorder_point", "variants_to_reorder"),
    )
    names = dim_warehouses.select("warehouse_id", "warehouse_code", "warehouse_name")
    return stock.join(names, "warehouse_id", "left")


def return_rate_by_category(
    return_items: DataFrame,
    fct_order_items: DataFrame,
    enriched_products: DataFrame,
) -> DataFrame:
    """Primary category: returned units out of the units of revenue lines.

    Both sides shrink to products before categories come in, so a category that
    holds most products is no hot join key.
    """
    lines = fct_order_items.where("is_revenue_order")
    back = (
        return_items.select("order_item_id", F.col("quantity").alias("returned"))
        .join(lines.select("order_item_id", "product_id"), "order_item_id")
        .groupBy("product_id")
        .agg(F.expr(total("returned")).alias("returned_units"))
    )
    sold = lines.groupBy("product_id").agg(F.expr(total("quantity")).alias("units_sold"))
    return (
        sold.join(back, "product_id", "left")
        .join(
            enriched_products.select("product_id", "primary_category_id", "category_path"),
            "product_id",
            "left",
        )
        .groupBy("primary_category_id", "category_path")
        .agg(*totals(["units_sold", "returned_units"]))
        .withColumn("return_rate", F.expr(ratio("returned_units", "units_sold")))
    )


def refunds_by_day(fct_refunds: DataFrame) -> DataFrame:
    return (
        fct_refunds.where("is_completed")
        .groupBy("refund_date")
        .agg(F.count("*").alias("refund_count"), *totals(["refund_cents"]))
    )


def return_reasons(fct_returns: DataFrame) -> DataFrame:
    return fct_returns.groupBy("return_reason").agg(F.count("*").alias("return_count"))
