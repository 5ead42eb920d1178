"""Silver dimensions: one clean row per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import (
    blank_to_null,
    clean_lower,
    clean_upper,
    day_of_week0,
    ratio,
)

# Raw product statuses that count as sold actively.
ACTIVE_PRODUCT_STATUSES = ("active", "published")


def categories(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("id").alias("category_id"),
        "parent_id",
        F.trim("name").alias("category_name"),
        clean_lower("slug").alias("category_slug"),
        F.col("path").alias("category_path"),
        F.isnull("parent_id").alias("is_root"),
        "created_at",
        "updated_at",
    )


def latest_default_addresses(addresses: DataFrame) -> DataFrame:
    """One default shipping address per customer: the last updated, then the lowest id.

    The rank filter lets Spark keep one row per customer in each map task before
    the shuffle, so a customer with very many addresses sends few rows.
    """
    newest_first = Window.partitionBy("customer_id").orderBy(
        F.col("updated_at").desc_nulls_last(), F.col("id").asc()
    )
    return (
        addresses.where("is_default_shipping")
        .select("customer_id", "id", "updated_at", "city", "state", "postal_code", "country_code")
        .withColumn("place", F.row_number().over(newest_first))
        .where("place = 1")
        .select(
            "customer_id",
            F.col("city").alias("default_city"),
            F.col("state").alias("default_state"),
            F.col("postal_code").alias("default_postal_code"),
            F.col("country_code").alias("default_country_code"),
        )
    )


def customers(source: DataFrame, addresses: DataFrame) -> DataFrame:
    named = source.select(
        F.col("id").alias("customer_id"),
        "user_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        "phone",
        "date_of_birth",
        F.coalesce("marketing_opt_in", F.lit(False)).alias("marketing_opt_in"),
        "lifetime_value_cache",
        "created_at",
        "updated_at",
    )
    # Both parts blank leaves just the separator; a null part makes the name null.
    joined_name = F.concat("first_name", F.lit(" "), "last_name")
    return named.withColumn("full_name", F.nullif(joined_name, F.lit(" "))).join(
        latest_default_addresses(addresses), "customer_id", "left"
    )


def dates(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order, with calendar fields."""
    day = F.to_date("placed_at")
    span = orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    days = span.where("first_day is not null").select(
        F.explode(F.sequence("first_day", "last_day")).alias("date_day")
    )
    weekday = day_of_week0("date_day")
    return days.select(
        "date_day",
        F.year("date_day").alias("year_number"),
        F.quarter("date_day").alias("quarter_number"),
        F.month("date_day").alias("month_number"),
        F.dayofmonth("date_day").alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format("date_day", "yyyy-MM").alias("year_month"),
        F.concat(F.date_format("date_day", "yyyy"), F.lit("-Q"), F.quarter("date_day")).alias(
            "year_quarter"
        ),
        F.date_format("date_day", "EEEE").alias("day_name"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def products(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("id").alias("product_id"),
        "brand_id",
        F.trim("name").alias("product_name"),
        clean_lower("slug").alias("product_slug"),
        "description",
        clean_lower("status").alias("product_status"),
        # On the raw status: a padded or capitalised one is not active.
        F.col("status").isin(*ACTIVE_PRODUCT_STATUSES).alias("is_active"),
        "created_at",
        "updated_at",
    )


def variants(source: DataFrame, dim_products: DataFrame) -> DataFrame:
    parents = dim_products.select("product_id", "product_name", "product_status")
    costed = source.withColumn("cost_cents", F.coalesce("cost_cents", F.lit(0).cast("long")))
    return costed.join(parents, "product_id").select(
        F.col("id").alias("variant_id"),
        "product_id",
        "product_name",
        "product_status",
        clean_upper("sku").alias("sku"),
        F.trim("name").alias("variant_name"),
        "attributes",
        "price_cents",
        "compare_at_price_cents",
        "cost_cents",
        "weight_grams",
        F.coalesce("is_active", F.lit(False)).alias("is_active"),
        F.expr(ratio("price_cents - cost_cents", "price_cents")).alias("list_margin_pct"),
        "created_at",
        "updated_at",
    )


def payment_methods(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("id").alias("payment_method_id"),
        clean_lower("code").alias("method_code"),
        F.trim("name").alias("method_name"),
    )


def warehouses(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("id").alias("warehouse_id"),
        clean_upper("code").alias("warehouse_code"),
        F.trim("name").alias("warehouse_name"),
        blank_to_null("city").alias("city"),
        clean_upper("country_code").alias("country_code"),
        F.coalesce("is_active", F.lit(False)).alias("is_active"),
    )


def product_categories(source: DataFrame) -> DataFrame:
    """Each product with each of its categories once."""
    return source.select("product_id", "category_id").distinct()


def primary_categories(product_categories: DataFrame) -> DataFrame:
    """The lowest category id per product, so that no product counts twice."""
    return product_categories.groupBy("product_id").agg(
        F.min("category_id").alias("primary_category_id")
    )


def enriched_products(
    dim_products: DataFrame,
    brands: DataFrame,
    dim_categories: DataFrame,
    product_categories: DataFrame,
) -> DataFrame:
    """Products with brand name and primary category."""
    brand_names = brands.select(F.col("id").alias("brand_id"), F.trim("name").alias("brand_name"))
    category_names = dim_categories.select(
        F.col("category_id").alias("primary_category_id"), "category_name", "category_path"
    )
    return (
        dim_products.join(brand_names, "brand_id", "left")
        .join(primary_categories(product_categories), "product_id", "left")
        .join(category_names, "primary_category_id", "left")
        .select(
            "product_id",
            "product_name",
            "product_status",
            "is_active",
            "brand_id",
            "brand_name",
            "primary_category_id",
            "category_name",
            "category_path",
        )
    )
