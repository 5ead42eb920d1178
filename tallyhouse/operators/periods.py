"""Marts by week, month, quarter or year, with exact distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import mean_rating, ratio, totals

UNITS = ("WEEK", "MONTH", "QUARTER", "YEAR")


def period(unit: str, date: str = "order_date") -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    return F.date_trunc(unit, date).cast("date").alias("period_start")


def by_period(
    mart: DataFrame,
    unit: str,
    keys: Sequence[str],
    measures: Sequence[str],
    ratios: dict[str, tuple[str, str]] | None = None,
    date: str = "order_date",
) -> DataFrame:
    """A daily mart by period and ``keys``: sums of ``measures``, and ratios anew from them.

    Orders, carts and the like have one day each, so their daily counts add up. Where one
    thing counts on several days, ``sku_counts`` has the count of a period.
    """
    made = mart.groupBy(period(unit, date), *keys).agg(*totals(measures))
    for name, (part, whole) in (ratios or {}).items():
        made = made.withColumn(name, F.expr(ratio(part, whole)))
    return made


def variant_numbers(dim_variants: DataFrame) -> DataFrame:
    """(variant_id, number): a product's variants, numbered from 1 without gaps.

    Dense numbers keep bitmaps short; the window holds the variants of one product.
    """
    place = F.row_number().over(Window.partitionBy("product_id").orderBy("variant_id"))
    return dim_variants.select("variant_id", place.cast("long").alias("number"))


def extended_numbers(known: DataFrame, dim_variants: DataFrame) -> DataFrame:
    """Numbers for variants that came since ``known`` was made; those it has stay.

    Bitmaps of earlier days hold their numbers, so these must never move.
    """
    rows = dim_variants.select("product_id", "variant_id").join(known, "variant_id", "left")
    own = Window.partitionBy("product_id")
    last = F.coalesce(F.max("number").over(own), F.lit(0))
    fresh = F.row_number().over(own.orderBy(F.col("number").isNotNull(), "variant_id"))
    return rows.select("variant_id", F.coalesce("number", last + fresh).alias("number"))


# The bitmap of ascending ``places``: at the first place of each byte, zero bytes up to
# there and the bits of the byte, which the next eight places hold at most.
_BITMAP = """
    unhex(array_join(transform(places, (p, i) ->
        if(i > 0 and places[i - 1] div 8 = p div 8, '', concat(
            repeat('00', cast(p div 8 - if(i = 0, 0L, places[i - 1] div 8 + 1) as int)),
            lpad(hex(aggregate(slice(places, i + 1, 8), 0L,
                (bits, q) -> if(q div 8 = p div 8, bits | shiftleft(1L, q % 8), bits))), 2, '0')))), ''))
"""

# A bitmap's words of seven bytes, the last one filled up with zeros.
_WORDS = """
    transform(sequence(0, (length(variant_bits) - 1) div 7), i ->
        cast(conv(rpad(hex(substring(variant_bits, cast(7 * i as int) + 1, 7)), 14, '0'), 16, 10) as bigint))
"""


def sold_variants(fct_order_items: DataFrame, numbers: DataFrame) -> DataFrame:
    """Day x product x bucket: the variants sold, as a bitmap of their numbers.

    Bitmaps of days can be merged to those of any period, which counts cannot. Lines
    shrink to distinct (day, product, variant) in the map tasks before they meet the
    numbers. A bitmap ends at its last set byte: most take one byte. It is put together
    from the set of its places; Spark's bitmap aggregates would hold 4 KB for each group.
    """
    sold = (
        fct_order_items.where("is_revenue_order").select("order_date", "product_id", "variant_id").distinct()
    )
    return (
        sold.join(numbers, "variant_id")
        .groupBy("order_date", "product_id", F.expr("bitmap_bucket_number(number)").alias("bucket"))
        .agg(F.expr("array_sort(collect_set(cast(bitmap_bit_position(number) as int)))").alias("places"))
        .select("order_date", "product_id", "bucket", F.expr(_BITMAP).alias("variant_bits"))
    )


def sku_counts(mart_sold_variants: DataFrame, unit: str) -> DataFrame:
    """(period_start, product_id, sku_count): distinct variants sold in the period.

    A variant belongs to one product, so the counts add up over products. Bitmaps are
    merged word by word: most have one.
    """
    words = mart_sold_variants.select(
        period(unit), "product_id", "bucket", F.posexplode(F.expr(_WORDS)).alias("place", "word")
    )
    merged = words.groupBy("period_start", "product_id", "bucket", "place").agg(F.bit_or("word").alias("word"))
    return merged.groupBy("period_start", "product_id").agg(F.expr("bigint(sum(bit_count(word))) as sku_count"))


def product_sales_by(
    mart_product_sales: DataFrame, mart_sold_variants: DataFrame, unit: str, measures: Sequence[str]
) -> DataFrame:
    """The product mart by period, with the distinct SKUs of the period.

    Names are looked up per product, so that no text is aggregated with the sums.
    """
    sums = by_period(
        mart_product_sales,
        unit,
        ["product_id"],
        ["order_count", *measures],
        {"gross_margin_pct": ("gross_margin_cents", "gross_revenue_cents")},
    )
    return (
        sums.join(sku_counts(mart_sold_variants, unit), ["period_start", "product_id"], "left")
        .na.fill(0, ["sku_count"])
        .join(product_names(mart_product_sales), "product_id", "left")
    )


def product_names(mart_product_sales: DataFrame) -> DataFrame:
    """The last name in alphabetical order of each product in the mart.

    A set of names, of which a product has few, is hashed; a maximum of text would
    make Spark sort all rows.
    """
    names = mart_product_sales.select("product_id", "product_name").distinct()
    return names.groupBy("product_id").agg(F.array_max(F.collect_set("product_name")).alias("product_name"))


def attribute_sales_by(
    by_product: DataFrame, products: DataFrame, key: str, measures: Sequence[str]
) -> DataFrame:
    """``product_sales_by`` per attribute of products (brand, primary category, ...).

    ``order_count`` is left out: an order counts once for each of its products.
    """
    return (
        by_product.join(products.select("product_id", key), "product_id", "left")
        .groupBy("period_start", key)
        .agg(*totals(["sku_count", *measures]))
        .withColumn("gross_margin_pct", F.expr(ratio("gross_margin_cents", "gross_revenue_cents")))
    )


def daily_sales_by(mart_daily_sales: DataFrame, unit: str, measures: Sequence[str]) -> DataFrame:
    """The daily mart by period; ratios anew from the sums."""
    return (
        mart_daily_sales.groupBy(period(unit))
        .agg(*totals(measures), F.expr(mean_rating()).alias("avg_rating"))
        .withColumn("aov_cents", F.expr(ratio("gmv_cents", "order_count")))
        .withColumn("refund_rate", F.expr(ratio("refund_cents", "gmv_cents", "0")))
    )
