"""The category tree and the marts over it."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import categories
from tallyhouse.operators.marts import PRODUCT_MEASURES

TREE = "category_id long, parent_id long, category_name string"


def tree_of(spark, parents):
    return spark.createDataFrame([(c, p, f"n{c}") for c, p in parents.items()], TREE)


def plain_path(parents, node):
    """Ids from the root to the node, or None where they go round."""
    path = [node]
    while parents[path[-1]] in parents:
        path.append(parents[path[-1]])
        if len(path) > len(parents):
            return None
    return path[::-1]


def random_parents(seed):
    draw = random.Random(seed)
    parents = {0: None, 1: 0, 2: 77_777, 3: 4, 4: 5, 5: 3, 6: 5, 7: 6, 8: 8}
    for node in range(9, 400):
        parents[node] = draw.choice([*parents][-6:] + [None] * 1 + [draw.choice([*parents])])
    return parents


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_and_ancestors_are_the_plain_ones(spark, seed):
    parents = random_parents(seed)
    tree = tree_of(spark, parents)
    paths = {c: plain_path(parents, c) for c in parents}
    found = {tuple(r) for r in categories.category_paths(tree).collect()}
    assert found == {(c, len(p) - 1, " > ".join(f"n{x}" for x in p), p[0]) for c, p in paths.items() if p}
    closure = [tuple(r) for r in categories.category_closure(tree).collect()]
    assert Counter(closure) == Counter(
        (c, a, depth, len(p) - 1 - depth) for c, p in paths.items() if p for depth, a in enumerate(p)
    )
    lost = {r.category_id for r in categories.categories_without_root(tree).collect()}
    assert lost == {c for c, p in paths.items() if p is None} and {3, 4, 5, 6, 7, 8} <= lost


def test_no_categories(spark):
    tree = tree_of(spark, {1: None}).where("false")
    assert categories.category_paths(tree).count() == 0
    assert categories.category_closure(tree).count() == 0
    assert categories.categories_without_root(tree).count() == 0


def test_a_chain_of_ten_thousand_levels(spark):
    tree = spark.range(10_000).selectExpr(
        "id as category_id", "if(id = 0, null, id - 1) as parent_id", "'n' as category_name"
    )
    found = categories.category_paths(tree).agg(
        F.count("*"), F.sum((F.col("depth") == F.col("category_id")).cast("int")),
        F.max(F.length("name_path")), F.max("root_id"),
    ).first()
    assert tuple(found) == (10_000, 10_000, 4 * 9_999 + 1, 0)


def test_two_million_categories_one_parent_with_most(spark):
    tree = spark.range(2_000_000).selectExpr(
        "id as category_id",
        "case when id < 1000 then null when id % 3 = 0 then 7 when id < 2000 then id - 1000 else id div 2 end as parent_id",
        "'n' as category_name",
    )
    found = categories.category_paths(tree).agg(F.count("*"), F.sum((F.col("root_id") < 1000).cast("int"))).first()
    assert tuple(found) == (2_000_000, 2_000_000)


def mart_of(spark, rows):
    columns = ", ".join(f"{m} long" for m in PRODUCT_MEASURES)
    frame = spark.createDataFrame(
        [(day, product, *[amount + i for i in range(len(PRODUCT_MEASURES))]) for day, product, amount in rows],
        f"order_date string, product_id long, {columns}",
    )
    return frame.withColumn("order_date", F.to_date("order_date"))


def test_every_level_adds_up_to_the_mart(spark):
    parents = {1: None, 2: 1, 3: 2, 4: 2, 5: 1, 6: None, 8: 9, 9: 8}
    links = [(10, 3), (10, 4), (10, 6), (11, 2), (11, 2), (12, 8), (12, 5), (13, 99), (14, 1), (14, 3)]
    sales = [("2024-01-01", p, 100 * p + 1) for p in range(10, 17)] + [("2024-01-02", 10, -17), ("2024-01-02", 12, -100)]
    mart = mart_of(spark, sales)
    product_categories = spark.createDataFrame(links, "product_id long, category_id long")
    closure = categories.category_closure(tree_of(spark, parents))
    wanted = mart.agg(*(F.sum(m) for m in PRODUCT_MEASURES)).first()
    for level in range(4):
        rows = categories.category_level_sales(mart, product_categories, closure, PRODUCT_MEASURES, level)
        assert rows.agg(*(F.sum(m) for m in PRODUCT_MEASURES)).first() == wanted
    tree = categories.category_tree_sales(mart, product_categories, closure, PRODUCT_MEASURES)
    roots = tree.where("category_id is null or depth = 0")
    assert roots.agg(*(F.sum(m) for m in PRODUCT_MEASURES)).first() == wanted
    # 1001 cents over three categories: two of them below category 2.
    units = {(str(r.order_date), r.category_id): r.units_sold for r in tree.collect()}
    assert [units["2024-01-01", c] for c in (4, 6)] == [334, 333]
    assert units["2024-01-01", 3] == 334 + 700 and units["2024-01-01", 2] == 334 + 334 + 700 + 1101
    assert units["2024-01-02", 6] == -6 and units["2024-01-02", 5] == -50
