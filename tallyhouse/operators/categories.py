"""The category tree: paths, ancestors, and sales of categories with all below them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import ratio, totals
from tallyhouse.operators.joins import join_grouped
from tallyhouse.session import shared_folder

SEPARATOR = " > "


def _placed(dim_categories: DataFrame, path: Column, separator: Column) -> DataFrame:
    """Every category with what is known of its path once all rounds are done.

    Columns: category_id; path, the concatenated ``path`` of all from ``top`` down to it;
    depth, the steps from there; above (null once top is a root).

    Pointer jumping: a category starts with its own part and a pointer to its parent.
    Each round it puts the path of the category it points to in front of its own, and
    points to where that one points, so what a path spans doubles: a tree of depth d takes
    log2(d) + 1 rounds, each one join. If a category off all circles were left after a
    round, one of its ancestors would have been reached in that round; so a round that
    reaches nobody is the last, and what is left hangs on a circle.
    """
    shared_folder(dim_categories.sparkSession)  # where rounds are kept
    known = dim_categories.select(F.col("category_id").alias("parent_id"), F.lit(True).alias("known")).distinct()
    at = join_grouped(dim_categories, known, "parent_id", "left").select(
        "category_id",
        path.alias("path"),
        F.lit(0).alias("depth"),
        F.col("category_id").alias("top"),
        F.when(F.col("known"), F.col("parent_id")).alias("above"),
    )
    at = at.checkpoint()
    while True:
        onward = at.select(
            F.col("category_id").alias("above"),
            F.col("path").alias("upper_path"),
            F.col("depth").alias("upper_depth"),
            F.col("top").alias("upper_top"),
            F.col("above").alias("next"),
        )
        moved = join_grouped(at.where("above is not null"), onward, "above").select(
            "category_id",
            F.concat("upper_path", separator, "path").alias("path"),
            (F.col("upper_depth") + F.col("depth") + 1).alias("depth"),
            F.col("upper_top").alias("top"),
            F.col("next").alias("above"),
        )
        moved = moved.checkpoint()
        if moved.where("above is null").isEmpty():
            return at
        at = at.where("above is null").unionByName(moved)


def category_paths(dim_categories: DataFrame) -> DataFrame:
    """Path of names from the root and depth, in trees of any depth and size.

    A category whose parent is unknown is a root. Categories in or below a circle have no
    root and no row here; ``categories_without_root`` lists them. A missing name makes
    the paths through it missing.
    """
    placed = _placed(dim_categories, F.col("category_name"), F.lit(SEPARATOR))
    return placed.where("above is null").select(
        "category_id", "depth", F.col("path").alias("name_path"), F.col("top").alias("root_id")
    )


def categories_without_root(dim_categories: DataFrame) -> DataFrame:
    """Categories whose parents lead round a circle."""
    lost = _placed(dim_categories, F.lit(""), F.lit("")).where("above is not null").select("category_id")
    return dim_categories.select("category_id", "parent_id").join(lost, "category_id", "left_semi")


def category_closure(dim_categories: DataFrame) -> DataFrame:
    """Each category with itself and all its ancestors: (category_id, ancestor_id, depth, distance).

    ``depth`` is the ancestor's. Categories without a root have no rows.
    """
    key = F.col("category_id")
    placed = _placed(dim_categories, F.array(key), F.array().cast(f"array<{dim_categories.schema['category_id'].dataType.simpleString()}>"))
    steps = placed.where("above is null").select(
        "category_id", F.col("depth").alias("steps"), F.posexplode("path").alias("depth", "ancestor_id")
    )
    return steps.select("category_id", "ancestor_id", "depth", (F.col("steps") - F.col("depth")).alias("distance"))


def category_weights(product_categories: DataFrame) -> DataFrame:
    """(product_id, category_id, place, parts): each product's categories, numbered from 0.

    A product counts in each of its ``parts`` categories by an equal part. The window
    holds the categories of one product.
    """
    links = product_categories.select("product_id", "category_id").distinct()
    own = Window.partitionBy("product_id")
    return links.select(
        "product_id",
        "category_id",
        (F.row_number().over(own.orderBy("category_id")) - 1).alias("place"),
        F.count("*").over(own).alias("parts"),
    )


def _part(measure: str) -> str:
    """One part of a whole number, in whole numbers that add up to it.

    All parts have the same remainder, so the largest ones are the first of them.
    """
    rest = f"pmod({measure}, parts)"
    return f"(({measure} - {rest}) div parts) + if(place < {rest}, 1L, 0L)"


def category_parts(
    mart_product_sales: DataFrame, product_categories: DataFrame, measures: Sequence[str]
) -> DataFrame:
    """Day x category: sales of the products, each spread over its categories.

    Sums over all categories are those of the mart: products without a category
    stay, under a null one.
    """
    weights = category_weights(product_categories)
    spread = (
        mart_product_sales.select("order_date", "product_id", *measures)
        .join(weights, "product_id", "left")
        .na.fill({"place": 0, "parts": 1})
    )
    parts = [F.expr(f"{_part(measure)} as {measure}") for measure in measures]
    return spread.select("order_date", "category_id", *parts).groupBy("order_date", "category_id").agg(*totals(measures))


def category_tree_sales(
    mart_product_sales: DataFrame,
    product_categories: DataFrame,
    category_closure: DataFrame,
    measures: Sequence[str],
) -> DataFrame:
    """Day x category: sales in the category and in all below it.

    Products in several categories are spread over them in whole cents, so a category
    holds the sum of its children and of its own products, and the roots together hold
    what the mart holds, but for one row a day with a null category: products
    without a category, or in one without a root. Lines meet the tree as one row per
    day and category.
    """
    own = category_parts(mart_product_sales, product_categories, measures)
    above = category_closure.select("category_id", "ancestor_id", "depth")
    return (
        own.join(above, "category_id", "left")
        .groupBy("order_date", F.col("ancestor_id").alias("category_id"), "depth")
        .agg(*totals(measures))
        .withColumn("gross_margin_pct", F.expr(ratio("gross_margin_cents", "gross_revenue_cents")))
    )


def category_level_sales(
    mart_product_sales: DataFrame,
    product_categories: DataFrame,
    category_closure: DataFrame,
    measures: Sequence[str],
    level: int,
) -> DataFrame:
    """Day x category of one level of the tree; each level adds up to the mart.

    Sales count for the ancestor at ``level`` (0 for roots), or, in a category above
    that level, for the category itself.
    """
    own = category_parts(mart_product_sales, product_categories, measures)
    at_level = category_closure.where(
        (F.col("depth") == level) | ((F.col("distance") == 0) & (F.col("depth") < level))
    ).select("category_id", "ancestor_id")
    return (
        own.join(at_level, "category_id", "left")
        .groupBy("order_date", F.col("ancestor_id").alias("category_id"))
        .agg(*totals(measures))
        .withColumn("gross_margin_pct", F.expr(ratio("gross_margin_cents", "gross_revenue_cents")))
    )
