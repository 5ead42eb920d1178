"""Every registered query with the SQL that checks it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import changes
from checks.bronze_sql import BRONZE
from checks.compose import with_blocks
from checks.analytics_sql import ANALYTICS, ANALYTICS_QUERIES
from checks.marts_sql import CAPTURED_QUERIES, LOOKUP_QUERIES, MART_QUERIES, QUALITY_QUERIES, QUALITY_SUITE
from checks.silver_sql import GOLD, SILVER
from tallyhouse.functions.expressions import ratio, totals
from tallyhouse.operators import analytics, categories, dimensions, lookups, marts, periods, quality, sales
from tallyhouse.plans import capture, data_tests, paths, quality_suite
from tallyhouse.operators.bronze import LOAD_COLUMNS
from tallyhouse.plans.bundle import section_rows, shared_bundle
from tallyhouse.plans.incremental import (
    refresh_changes,
    refresh_months,
    refresh_silver_months,
    touched_months,
)
from tallyhouse.plans.medallion import (
    FURTHER_MARTS,
    REQUEST_MARTS,
    SILVER_MODELS,
    gold_over,
    silver_over,
)
from tallyhouse.plans.refresh import refresh_bronze, refresh_gold, refresh_marts, refresh_silver
from tallyhouse.session import configure, partitions_for, shared_folder
from tallyhouse.sources.access import json_rows, query_with_parameters
from checks.testbed import Testbed
from tallyhouse.sources.warehouse import MONTH, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

BLOCKS = {**BRONZE, **SILVER, **GOLD, **ANALYTICS}

# The demo window: 60 days including both ends.
SPAN = analytics.resolve_range("1998-01-01", "1998-03-01")

# Of what captured changes reach, the tables that are checked, and what they are made from.
CAPTURED_BRONZE = ["orders", "order_items", "payments", "refunds", "carts", "cart_items"]
CAPTURED_FACTS = ["fct_orders", "fct_order_items", "fct_payments", "fct_refunds"]
CAPTURED_SILVER = ["dim_products", "dim_variants", *CAPTURED_FACTS, "fct_carts", "fct_reviews"]
CAPTURED_MARTS = ["mart_daily_sales", "mart_product_sales", "mart_customer_months"]
CUSTOMER_MARTS = ["mart_customer_cohorts", "mart_customer_ltv", "mart_orders_per_customer"]

# Gold marts written by this process, by application and folder of test files.
_written: dict[tuple[str, str], Warehouse] = {}

# Files whose rows are shuffled most, and their rows by application and folder.
LARGE_FILES = ["lineitem", "orders", "events"]
_rows: dict[tuple[str, str], int] = {}


def initial_partitions(spark: SparkSession, folder: str) -> int:
    """Shuffle partitions in proportion to the files, at least as many as the session has.

    Rows are counted from the files' footers.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _rows:
        _rows[key] = max(spark.read.parquet(f"{folder}/{name}.parquet").count() for name in LARGE_FILES)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(_rows[key]))


class Layers:
    """All layers over one folder of test files: lazy ones, and the written gold marts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark, initial_partitions(spark, folder))
        self.folder = folder
        self.bronze = Testbed(self.spark, folder)
        self.silver = silver_over(self.bronze)
        self.gold = gold_over(self.silver)

    def bronze_table(self, name: str) -> DataFrame:
        return self.bronze.table(name)

    def silver_table(self, name: str) -> DataFrame:
        return self.silver.table(name)

    def gold_table(self, name: str) -> DataFrame:
        return self.gold.table(name)

    def new_warehouse(self) -> Warehouse:
        application = self.spark.sparkContext.applicationId
        return Warehouse(
            self.spark,
            f"{shared_folder(self.spark)}/tallyhouse-{application}",
            f"t{uuid.uuid4().hex[:12]}_",
        )

    @property
    def marts(self) -> Warehouse:
        """A warehouse in the shared folder with the gold marts of these files."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _written:
            warehouse = self.new_warehouse()
            refresh_gold(warehouse, REQUEST_MARTS, self.silver)
            _written[key] = warehouse
        return _written[key]

    def written_mart(self, name: str) -> DataFrame:
        """A further mart, written and read back without its month column."""
        warehouse = self.new_warehouse()
        gold = gold_over(self.silver)
        gold.use_written("mart_product_sales", self.products)
        refresh_marts(warehouse, gold, [name])
        return warehouse.table("gold", name).drop(*MONTH.values())

    @property
    def enriched_products(self) -> DataFrame:
        return dimensions.enriched_products(
            self.silver_table("dim_products"),
            self.bronze_table("brands"),
            self.silver_table("dim_categories"),
            self.bronze_table("product_categories"),
        )

    def requests(self, layer: str) -> paths.Requests:
        """The benchmark requests from lazy silver over bronze, written silver, or gold."""
        if layer == "gold":
            return paths.GoldRequests(self.marts.layer("gold"), SPAN, 15)
        if layer == "silver":
            return paths.SilverRequests(self.written_silver.layer("silver"), SPAN, 15)
        return paths.SilverRequests(self.silver, SPAN, 15)

    @property
    def written_silver(self) -> Warehouse:
        """A warehouse with the silver tables the benchmark requests read."""
        key = (self.spark.sparkContext.applicationId, self.folder + "#silver")
        if key not in _written:
            warehouse = self.new_warehouse()
            warehouse.create_databases()
            for name in ("fct_orders", "fct_order_items", "fct_refunds", "fct_reviews"):
                model = SILVER_MODELS[name]
                warehouse.replace("silver", name, self.silver.parts(name), model.month_of)
            _written[key] = warehouse
        return _written[key]

    @property
    def captured(self) -> Warehouse:
        """All layers over the files as they were, then brought up to date by changed rows."""
        key = (self.spark.sparkContext.applicationId, self.folder + "#captured")
        if key not in _written:
            warehouse = self.new_warehouse()
            warehouse.create_databases()
            with warehouse.release() as release:
                first = changes.Before(self.bronze)
                refresh_bronze(release, first, ["products", "product_variants", "product_reviews"])
                capture.load(release, first, CAPTURED_BRONZE)
                refresh_silver(release, CAPTURED_SILVER)
                refresh_gold(release, [*CAPTURED_MARTS, "mart_funnel_daily", *CUSTOMER_MARTS])
            later = changes.After(self.bronze)
            refresh_changes(warehouse, later, CAPTURED_BRONZE, CAPTURED_FACTS, CAPTURED_MARTS)
            _written[key] = warehouse
        return _written[key]

    def captured_frame(self, layer: str, name: str) -> DataFrame:
        """A captured table without its month and load columns."""
        load = [column for column in MONTH if column.startswith("_")]
        return self.captured.table(layer, name).drop(*load, *MONTH.values(), *LOAD_COLUMNS)

    @property
    def tested(self) -> DataFrame:
        """Outcomes of all standard checks over written tables."""
        warehouse = self.new_warehouse()
        warehouse.create_databases()
        standard = data_tests.standard_checks()
        used = {(c.layer, c.table) for c in standard} | {c.parent[:2] for c in standard if c.parent}
        with warehouse.release() as release:
            for layer, name in sorted(used):
                tables = {"bronze": self.bronze, "silver": self.silver, "gold": self.marts.layer("gold")}[layer]
                frames = tables.parts(name) if layer == "silver" else tables.table(name)
                release.replace(layer, name, frames)
        layers = {layer: warehouse.layer(layer) for layer in ("bronze", "silver", "gold")}
        return data_tests.outcomes_by_table(layers, standard)

    @property
    def reconciled(self) -> DataFrame:
        """Control totals of the requests per layer."""
        # The marts first: their write takes most disk, beside which written silver need not lie.
        gold = self.requests("gold")
        return paths.reconciliation(self.requests("bronze"), self.requests("silver"), gold)

    @property
    def bundle(self) -> DataFrame:
        """All figures of one product request."""
        with shared_bundle(self.products, self.daily, SPAN, 15) as frames:
            return section_rows(frames).checkpoint()

    def incremental_fact(self, name: str) -> DataFrame:
        """The fact written up to 1999, then brought up to date month by month."""
        warehouse = self.new_warehouse()
        warehouse.create_databases()
        late = F.col("order_date") >= dt.date(2000, 1, 1)
        warehouse.replace("silver", name, [part.where(~late) for part in self.silver.parts(name)], "order_date")
        changed = self.silver_table("fct_orders").where(late)
        refresh_silver_months(warehouse, self.bronze, touched_months(changed), [name])
        return warehouse.table("silver", name)

    def incremental(self, name: str) -> DataFrame:
        """The mart written up to 1999, then brought up to date month by month."""
        warehouse = self.new_warehouse()
        warehouse.create_databases()
        late = F.col("order_date") >= dt.date(2000, 1, 1)
        warehouse.replace("gold", name, self.gold_table(name).where(~late), "order_date")
        changed = self.silver_table("fct_orders").where(late)
        refresh_months(warehouse, self.silver, touched_months(changed), [name])
        return warehouse.table("gold", name)

    @property
    def daily(self) -> DataFrame:
        return self.marts.table("gold", "mart_daily_sales")

    @property
    def products(self) -> DataFrame:
        return self.marts.table("gold", "mart_product_sales")

    @property
    def days(self) -> DataFrame:
        return analytics.product_days(self.products, SPAN)


def _catalogue() -> dict[str, tuple[Callable[[Layers], DataFrame], str | None]]:
    found: dict[str, tuple[Callable[[Layers], DataFrame], str | None]] = {}

    def add(name: str, frame: Callable[[Layers], DataFrame], sql: str | None) -> None:
        if name in found:
            raise KeyError(f"{name} is registered twice")
        found[name] = (frame, sql)

    for table in Testbed.TABLES:
        add(f"bronze_{table}", lambda x, t=table: x.bronze_table(t), f"select * from b_{table}")

    for table in SILVER_MODELS:
        block = "s_" + table.split("_", 1)[1]
        add(f"silver_{table}", lambda x, t=table: x.silver_table(t), f"select * from {block}")
    add("silver_product_enrichment", lambda x: x.enriched_products,
        "select * from s_enriched_products")
    add(
        "silver_category_paths",
        lambda x: categories.category_paths(x.silver_table("dim_categories")),
        "select * from s_category_paths",
    )

    add("gold_order_refunds", lambda x: sales.order_refunds(x.silver_table("fct_refunds")),
        "select * from g_order_refunds")
    add("gold_daily_orders",
        lambda x: sales.daily_orders(x.silver_table("fct_orders"), x.silver_table("fct_refunds")),
        "select * from g_daily_orders")
    add("gold_daily_reviews", lambda x: sales.daily_reviews(x.silver_table("fct_reviews")),
        "select * from g_daily_reviews")
    add("gold_mart_daily_sales", lambda x: x.gold_table("mart_daily_sales"), "select * from g_daily")
    add("gold_order_line_totals",
        lambda x: sales.order_line_totals(x.silver_table("fct_order_items").where("is_revenue_order")),
        "select distinct order_id, cast(order_lines_cents as bigint) as order_lines_cents from g_lines")
    add("gold_line_refunds",
        lambda x: sales.line_refunds(x.silver_table("fct_order_items"), x.silver_table("fct_refunds")),
        "select order_item_id, order_id, order_date, product_id, variant_id, line_total_cents,"
        " order_refund_cents, cast(order_lines_cents as bigint) as order_lines_cents, refund_cents"
        " from g_lines where order_refund_cents > 0")
    add("gold_mart_product_sales", lambda x: x.gold_table("mart_product_sales"), "select * from g_product")

    def on_gold(name: str, frame: Callable[[Layers], DataFrame]) -> None:
        add(f"analytics_{name}", frame, ANALYTICS_QUERIES[name])

    on_gold("product_days", lambda x: x.days)
    on_gold("summary_totals", lambda x: analytics.summary_totals(x.days, x.daily, SPAN))
    on_gold("summary", lambda x: analytics.summary(x.days, x.daily, SPAN))
    on_gold("revenue_over_time", lambda x: analytics.revenue_over_time(x.days, x.daily, SPAN))
    on_gold("top_products", lambda x: analytics.top_products(x.days, 15))
    on_gold("portfolio_ranks", lambda x: analytics.portfolio_ranks(x.days))
    on_gold("portfolio_buckets", lambda x: analytics.portfolio_buckets(x.days))
    on_gold("portfolio_concentration", lambda x: analytics.portfolio_concentration(x.days))
    on_gold("refund_summary", lambda x: analytics.refund_summary(x.days, x.daily, SPAN))
    on_gold("refunds_over_time", lambda x: analytics.refunds_over_time(x.days, x.daily, SPAN))
    on_gold("refunds_by_product", lambda x: analytics.refunds_by_product(x.days, 15))
    on_gold("bundle", lambda x: x.bundle)
    on_gold(
        "revenue_chart",
        lambda x: analytics.revenue_chart(analytics.revenue_over_time(x.days, x.daily, SPAN)),
    )
    on_gold(
        "top_products_chart",
        lambda x: analytics.top_products_chart(analytics.top_products(x.days, 15)),
    )
    on_gold(
        "refunds_chart",
        lambda x: analytics.refunds_chart(analytics.refunds_by_product(x.days, 15)),
    )

    def mart(name: str, frame: Callable[[Layers], DataFrame]) -> None:
        add(f"mart_{name}", frame, MART_QUERIES[f"mart_{name}"])

    def ltv(x: Layers) -> DataFrame:
        return marts.customer_ltv(x.silver_table("fct_orders"))

    def variant_sales(x: Layers) -> DataFrame:
        return marts.variant_sales(
            x.silver_table("fct_order_items"), x.silver_table("fct_refunds")
        )

    for table in FURTHER_MARTS:
        if table != "mart_sold_variants":
            mart(table.removeprefix("mart_"), lambda x, t=table: x.written_mart(t))
    mart(
        "sold_variants",
        lambda x: x.written_mart("mart_sold_variants").select(
            "order_date", "product_id", "bucket", F.expr("bitmap_count(variant_bits) as sku_count")
        ),
    )

    mart(
        "orders_by_status_stacked",
        lambda x: marts.orders_by_status_stacked(
            x.silver_table("fct_orders"), quality_suite.ORDER_STATUSES
        ),
    )
    mart("top_skus", lambda x: marts.top_skus(variant_sales(x), SPAN, 10))
    mart(
        "product_sales_with_names",
        lambda x: marts.product_sales_with_names(
            x.products.drop("order_month"), x.enriched_products
        ),
    )
    mart(
        "slow_movers",
        lambda x: marts.slow_movers(x.silver_table("dim_products"), x.products, SPAN.end),
    )
    mart("top_customers", lambda x: marts.top_customers(ltv(x), 20))
    mart(
        "promo_performance",
        lambda x: marts.promo_performance(
            x.bronze_table("coupons"),
            x.bronze_table("coupon_redemptions"),
            x.silver_table("fct_orders"),
        ),
    )
    mart(
        "return_rate_by_category",
        lambda x: marts.return_rate_by_category(
            x.bronze_table("return_items"), x.silver_table("fct_order_items"), x.enriched_products
        ),
    )
    daily, product = marts.DAILY_MEASURES, marts.PRODUCT_MEASURES
    mart("daily_sales_by_week", lambda x: periods.daily_sales_by(x.daily, "WEEK", daily))
    mart("daily_sales_by_month", lambda x: periods.daily_sales_by(x.daily, "MONTH", daily))

    def by_product(x: Layers, unit: str) -> DataFrame:
        return periods.product_sales_by(x.products, x.gold_table("mart_sold_variants"), unit, product)

    for unit in ("week", "month", "quarter"):
        mart(f"product_sales_by_{unit}", lambda x, u=unit.upper(): by_product(x, u))
    margin = {"gross_margin_pct": ("gross_margin_cents", "gross_revenue_cents")}
    mart(
        "variant_sales_by_month",
        lambda x: periods.by_period(
            variant_sales(x), "MONTH", ["variant_id"], ["order_count", *product], margin
        ),
    )
    mart(
        "category_sales_by_month",
        lambda x: periods.attribute_sales_by(
            by_product(x, "MONTH"), x.enriched_products, "primary_category_id", product
        ),
    )
    mart(
        "brand_sales_by_quarter",
        lambda x: periods.attribute_sales_by(
            by_product(x, "QUARTER"), x.enriched_products, "brand_id", product
        ),
    )
    mart(
        "orders_by_status_by_week",
        lambda x: periods.by_period(
            x.gold_table("mart_orders_by_status"), "WEEK", ["order_status"], ["order_count", "gmv_cents"]
        ),
    )
    mart(
        "funnel_by_week",
        lambda x: periods.by_period(
            x.gold_table("mart_funnel_daily"),
            "WEEK",
            [],
            ["carts_created", "carts_with_items", "orders", "abandoned_carts"],
            {"abandoned_rate": ("abandoned_carts", "carts_created")},
            "cart_date",
        ),
    )
    mart(
        "payment_success_by_month",
        lambda x: periods.by_period(
            x.gold_table("mart_payment_success"),
            "MONTH",
            [],
            ["payment_count", "succeeded_count"],
            {"success_rate": ("succeeded_count", "payment_count")},
            "payment_date",
        ),
    )
    mart(
        "refunds_by_month",
        lambda x: periods.by_period(
            x.gold_table("mart_refunds_by_day"), "MONTH", [], ["refund_count", "refund_cents"], date="refund_date"
        ),
    )

    def at_level(x: Layers, level: int) -> DataFrame:
        return categories.category_level_sales(
            x.products,
            x.silver_table("dim_product_categories"),
            x.silver_table("dim_category_closure"),
            product,
            level,
        )

    def level_totals(x: Layers) -> DataFrame:
        """Totals of some levels of the tree, and whether they are those of the mart."""
        wanted = x.products.agg(*totals(product)).select(F.struct(*product).alias("all"))
        rows = None
        for level in (0, 1, 3):
            row = at_level(x, level).agg(*totals(product)).select(F.lit(level).alias("level"), "*")
            rows = row if rows is None else rows.unionByName(row)
        return rows.select(
            "*",
            F.expr(f"{ratio('gross_margin_cents', 'gross_revenue_cents')} as gross_margin_pct"),
            (F.struct(*product) == wanted.scalar()).alias("agrees"),
        )

    for level in (0, 1, 3):
        mart(f"category_sales_level_{level}", lambda x, n=level: at_level(x, n))
    mart("category_level_totals", level_totals)
    mart("overview", lambda x: marts.overview(x.daily))

    def lookup(name: str, frame: Callable[[Layers], DataFrame]) -> None:
        add(name, frame, LOOKUP_QUERIES[name])

    def refund_candidates(x: Layers) -> DataFrame:
        return lookups.refund_candidates(
            x.bronze_table("orders"), x.bronze_table("order_items"), x.bronze_table("payments")
        )

    def review_candidates(x: Layers) -> DataFrame:
        return lookups.review_candidates(
            x.bronze_table("orders"),
            x.bronze_table("order_items"),
            x.bronze_table("product_variants"),
            x.bronze_table("products"),
        )

    def completeness(x: Layers) -> DataFrame:
        counted = ["products", "product_variants", "warehouses", "inventory_levels", "orders"]
        counted += ["order_items", "payments", "shipments", "returns", "product_reviews"]
        orders = F.col("orders")
        return lookups.completeness(
            {name: x.bronze_table(name) for name in counted},
            {
                "product_variants": F.col("products") * 3,
                "inventory_levels": F.col("product_variants") * F.col("warehouses"),
                "order_items": orders * 4,
                "payments": orders,
                "shipments": F.round(orders * 0.9),
                "returns": F.round(orders * 0.08),
                "product_reviews": F.round(orders * 0.35),
            },
        )

    lookup(
        "lookup_missing_stock_rows",
        lambda x: lookups.missing_stock_rows(
            x.bronze_table("warehouses"),
            x.bronze_table("product_variants"),
            x.bronze_table("inventory_levels"),
        ),
    )
    lookup("lookup_refund_candidates", refund_candidates)
    lookup(
        "lookup_refund_sample",
        lambda x: lookups.random_rows(refund_candidates(x), "order_item_id", 500, seed=7),
    )
    lookup("lookup_review_candidates", review_candidates)
    lookup(
        "lookup_review_sample",
        lambda x: lookups.random_rows(review_candidates(x), "order_item_id", 500, seed=7),
    )
    lookup(
        "lookup_variants",
        lambda x: lookups.variant_lookup(
            x.bronze_table("product_variants"), x.bronze_table("products")
        ),
    )
    lookup(
        "lookup_leaf_categories", lambda x: lookups.leaf_categories(x.bronze_table("categories"))
    )
    lookup("lookup_active_coupons", lambda x: lookups.active_coupons(x.bronze_table("coupons")))
    lookup("lookup_completeness", completeness)
    lookup("lookup_product_slugs", lambda x: lookups.product_slugs(x.bronze_table("products")))
    lookup(
        "lookup_addresses_by_customer",
        lambda x: lookups.addresses_by_customer(x.bronze_table("customer_addresses")),
    )
    lookup(
        "sql_with_parameters",
        lambda x: query_with_parameters(
            x.spark,
            f"""
            select product_id, sum(gross_revenue_cents) as gross_revenue_cents
            from {x.marts.full_name("gold", "mart_product_sales")}
            where order_date between cast(? as date) and cast(? as date)
            group by product_id order by gross_revenue_cents desc, product_id limit ?
            """,
            ["1998-01-01", "1998-03-01", 12],
        ),
    )
    lookup(
        "json_rows",
        lambda x: json_rows(
            x.daily.select(
                "order_date",
                "order_count",
                "gmv_cents",
                "review_count",
                F.lit(None).cast("string").alias("note"),
            )
        ),
    )
    lookup("incremental_product_sales", lambda x: x.incremental("mart_product_sales"))
    lookup("incremental_daily_sales", lambda x: x.incremental("mart_daily_sales"))
    for name, sql in CAPTURED_QUERIES.items():
        layer, table = name.removeprefix("captured_").split("_", 1)
        add(name, lambda x, l=layer, t=table: x.captured_frame(l, t), sql)
    lookup("incremental_order_items", lambda x: x.incremental_fact("fct_order_items"))

    def check(name: str, frame: Callable[[Layers], DataFrame]) -> None:
        add(f"dq_{name}", frame, QUALITY_QUERIES[f"dq_{name}"])

    add("dq_suite", lambda x: x.tested, QUALITY_SUITE)
    check("unique", lambda x: quality_suite.uniqueness(x.silver, x.marts.layer("gold")))
    check("not_null", lambda x: quality_suite.required(x.silver, x.marts.layer("gold")))
    check("relationships", lambda x: quality_suite.foreign_keys(x.bronze, x.silver))
    check("accepted_values", lambda x: quality_suite.enumerations(x.silver))
    check("rating_range", lambda x: quality_suite.rating_range(x.bronze))
    check("composite_keys", lambda x: quality_suite.composite_keys(x.bronze))
    check("natural_keys", lambda x: quality_suite.natural_keys(x.bronze))
    check("soft_rules", lambda x: quality_suite.soft_rules(x.bronze))
    check("dropped_rows", lambda x: quality_suite.dropped_rows(x.bronze))
    check("reconciliation", lambda x: x.reconciled)
    check("order_totals", lambda x: quality.order_total_mismatches(x.bronze_table("orders")))
    check(
        "payment_amounts",
        lambda x: quality.payment_mismatches(x.bronze_table("payments"), x.bronze_table("orders")),
    )
    check(
        "coupon_amounts",
        lambda x: quality.coupon_mismatches(
            x.bronze_table("coupon_redemptions"),
            x.bronze_table("coupons"),
            x.bronze_table("orders"),
        ),
    )

    for layer in ("bronze", "silver", "gold"):
        for request in ("summary", "revenue_over_time", "top_products"):
            add(
                f"path_{layer}_{request}",
                lambda x, l=layer, r=request: getattr(x.requests(l), r)(),
                ANALYTICS_QUERIES[request],
            )
    return found


def registered_queries() -> dict[str, Query]:
    return {
        name: lambda spark, folder, build=build: build(Layers(spark, folder))
        for name, (build, _) in _catalogue().items()
    }


def checking_sql() -> dict[str, str]:
    return {
        name: with_blocks(sql, BLOCKS)
        for name, (_, sql) in _catalogue().items()
        if sql is not None
    }
