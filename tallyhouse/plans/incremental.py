"""Refreshing facts and marts for some months instead of all of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import marts
from tallyhouse.plans.capture import ROUTES, capture_tables
from tallyhouse.plans.medallion import GOLD_MODELS, SILVER_MODELS, Model, Tables, silver_over
from tallyhouse.session import shared_folder
from tallyhouse.sources.warehouse import MONTH, Release, Warehouse, in_months


class _Months:
    """Tables of a layer cut to the given months of ``date``; those without it stay whole."""

    def __init__(self, layer: Tables, months: list[dt.date], date: str = "order_date"):
        self.layer = layer
        self.months = months
        self.date = date

    def table(self, name: str) -> DataFrame:
        frame = self.layer.table(name)
        date = "review_date" if name == "fct_reviews" else self.date
        if date not in frame.columns:
            return frame
        # On the partition column where the table has one, so other months are not read.
        month = F.col(MONTH[date]) if MONTH[date] in frame.columns else F.trunc(date, "MM")
        return frame.where(month.isin(self.months))


# Months are written together up to this many rows of their largest table, or an eighth of it.
# The shuffle files of a write are gone before the next one.
ROWS_A_WRITE = 4_000_000
WRITES = 8


def month_runs(months: list[dt.date], tables: Iterable[DataFrame]) -> list[list[dt.date]]:
    """Sorted months in runs that are written one after the other.

    Rows are counted, from the files' footers, in tables that lie by month; without one
    all months make one run. A month is never split.
    """
    counts: dict[dt.date, int] = {}
    for frame in tables:
        for column in {*MONTH.values()} & {*frame.columns}:
            for month, rows in frame.groupBy(column).count().collect():
                counts[month] = max(rows, counts.get(month, 0))
    most = max(ROWS_A_WRITE, sum(counts.get(month, 0) for month in months) // WRITES)
    runs, rows = [[]], 0
    for month in months:
        if runs[-1] and rows + counts.get(month, 0) > most:
            runs.append([])
            rows = 0
        runs[-1].append(month)
        rows += counts.get(month, 0)
    return runs


def refresh_months(
    warehouse: Warehouse | Release,
    silver: Tables,
    months: Iterable[dt.date],
    names: Iterable[str],
    date: str = "order_date",
) -> None:
    """Recompute the given months of marts partitioned by order month (or by that of ``date``).

    Everything a mart row needs has the row's own order date (refunds carry the
    date of their order), so a month depends on the silver rows of that month
    only. A month that has no rows any more is emptied too. A mart made from other
    marts reads their written months, so it comes behind them in ``names``. Many rows are
    written a run of months at a time, so that their shuffle files don't lie side by side.
    """
    wanted = sorted({month.replace(day=1) for month in months})
    with warehouse.release() as release:
        for name in names:
            model = GOLD_MODELS[name]
            if model.month_of != date:
                raise ValueError(f"{name} is not partitioned by months of {date}; refresh it otherwise")
            if not wanted:
                continue
            whole = _Months(silver, wanted, date)
            for run in month_runs(wanted, [whole.table(source) for source in model.below]):
                cut, made = _Months(silver, run, date), _Months(release.layer("gold"), run, date)
                inputs = [cut.table(source) for source in model.below]
                frame = model.make(*inputs, *[made.table(sibling) for sibling in model.beside])
                release.replace_months("gold", name, frame, model.month_of, run)


# Facts that follow the month of their order, and the one of reviews.
ORDER_FACTS = [
    "fct_orders",
    "fct_order_items",
    "fct_payments",
    "fct_refunds",
    "fct_shipments",
    "fct_returns",
]
REVIEW_FACTS = ["fct_reviews"]


class _BronzeMonths:
    """Bronze tables with orders and reviews cut to the given months.

    Tables that ``capture`` keeps by order month are read in those partitions alone.
    Elsewhere the cut is a range on the instant itself, which reaches the scan, and lines,
    payments and the like stay whole: joining them to the orders that are left cuts them.
    """

    INSTANTS = {"orders": "placed_at", "product_reviews": "created_at"}

    def __init__(self, bronze: Tables, months: list[dt.date]):
        self.bronze = bronze
        self.months = months

    def table(self, name: str) -> DataFrame:
        frame = self.bronze.table(name)
        if MONTH["_order_date"] in frame.columns:
            frame = frame.where(in_months(MONTH["_order_date"], self.months))
        if name not in self.INSTANTS:
            return frame
        instant = self.INSTANTS[name]
        ranges = [
            f"({instant} >= timestamp '{month}' and {instant} < timestamp '{_next(month)}')"
            for month in self.months
        ]
        return frame.where(" or ".join(ranges))


def _next(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=32)).replace(day=1)


def refresh_silver_months(
    warehouse: Warehouse | Release,
    bronze: Tables,
    months: Iterable[dt.date],
    names: Iterable[str] = (*ORDER_FACTS, *REVIEW_FACTS),
) -> None:
    """Recompute the given months of facts. An order that moved touches both its months.

    Many rows are written a run of months at a time, like those of marts.
    """
    wanted = sorted({month.replace(day=1) for month in months})
    if not wanted:
        return
    whole = _BronzeMonths(bronze, wanted)
    with warehouse.release() as release:
        for name in names:
            if name not in ORDER_FACTS and name not in REVIEW_FACTS:
                raise ValueError(f"{name} does not follow the month of orders or reviews")
            model = SILVER_MODELS[name]
            for run in month_runs(wanted, [whole.table(source) for source in model.below]):
                frame = silver_over(_BronzeMonths(bronze, run)).build(name)
                release.replace_months("silver", name, frame, model.month_of, run)


def touched_months(changes: DataFrame, date_column: str = "order_date") -> list[dt.date]:
    """Order months among changed rows: a short list, a calendar has few months."""
    months = changes.select(F.trunc(date_column, "MM").alias("month")).where("month is not null")
    return [row.month for row in months.distinct().collect()]


# -- changes with another date ----------------------------------------------------


def _changed_rows(release: Release, layer: str, name: str, columns: list[str], months: list[dt.date]) -> DataFrame:
    """Rows of some columns that the release took out of or put into a table's months."""
    old, new = (
        frame.where(F.col(MONTH["order_date"]).isin(months)).select(columns)
        for frame in (release.was(layer, name), release.table(layer, name))
    )
    return old.exceptAll(new).unionByName(new.exceptAll(old))


def refresh_cart_months(
    warehouse: Warehouse | Release,
    bronze: Tables,
    cart_months: Iterable[dt.date],
    order_months: Iterable[dt.date],
) -> list[dt.date]:
    """Bring ``fct_carts`` up to date, behind the orders' facts of the same release.

    A cart changes with its own month, or with an order of another: where an order of the
    given order months got, lost or changed its cart, the month of that cart is
    recomputed too. Returns the months of carts that were.
    """
    with warehouse.release() as release:
        orders = sorted({month.replace(day=1) for month in order_months})
        pairs = _changed_rows(release, "silver", "fct_orders", ["cart_id", "order_id"], orders)
        carts = bronze.table("carts").withColumn("_day", F.to_date("created_at"))
        ids = pairs.where("cart_id is not null").select(F.col("cart_id").alias("id")).distinct()
        moved = carts.join(ids, "id", "left_semi").select(F.trunc("_day", "MM"))
        months = {month.replace(day=1) for month in cart_months}
        months |= {row[0] for row in moved.distinct().collect() if row[0]}
        wanted = sorted(months)
        by_month = MONTH["_cart_date"]
        chosen = F.col(by_month) if by_month in carts.columns else F.trunc("_day", "MM")
        carts = carts.where(chosen.isin(wanted))
        items = bronze.table("cart_items")
        if by_month in items.columns:
            items = items.where(F.col(by_month).isin(wanted))
        items = items.join(carts.select(F.col("id").alias("cart_id")), "cart_id", "left_semi")
        frame = SILVER_MODELS["fct_carts"].make(carts, items, release.table("silver", "fct_orders"))
        release.replace_months("silver", "fct_carts", frame, "cart_date", wanted)
    return wanted


def refresh_customers(warehouse: Warehouse | Release, months: Iterable[dt.date]) -> None:
    """Bring lifetime values and cohorts up to date, behind ``mart_customer_months``.

    Only customers whose months changed are looked at, with all their months: an
    order that came late may move their first month, and with it every cell they
    stood in. Their old cells are taken out of the cohorts and the new ones put in.
    """
    wanted = sorted({month.replace(day=1) for month in months})
    with warehouse.release() as release:
        name = ("gold", "mart_customer_months")
        shared_folder(release.spark)
        rows = _changed_rows(release, *name, release.was(*name).drop(MONTH["order_date"]).columns, wanted)
        touched = rows.select("customer_id").distinct().checkpoint()
        before, after = (
            frame.join(touched, "customer_id", "left_semi") for frame in (release.was(*name), release.table(*name))
        )
        ltv = release.table("gold", "mart_customer_ltv").join(touched, "customer_id", "left_anti")
        release.replace(
            "gold", "mart_customer_ltv", ltv.unionByName(marts.ltv_of_months(after))
        )
        cells = ["cohort_month", "period_number", "active_customers"]
        out = marts.cohort_counts(before).withColumn("active_customers", -F.col("active_customers"))
        counts = (
            release.table("gold", "mart_customer_cohorts").select(cells)
            .unionByName(out)
            .unionByName(marts.cohort_counts(after))
            .groupBy("cohort_month", "period_number")
            .agg(F.sum("active_customers").alias("active_customers"))
            .where("active_customers > 0")
        )
        release.replace("gold", "mart_customer_cohorts", marts.with_retention(counts))
        histogram = GOLD_MODELS["mart_orders_per_customer"]
        release.replace(
            "gold", "mart_orders_per_customer", histogram.make(release.table("gold", "mart_customer_ltv"))
        )


CAPTURED_MARTS = [
    "mart_daily_sales",
    "mart_product_sales",
    "mart_orders_by_status",
    "mart_variant_sales",
    "mart_sold_variants",
    "mart_fulfillment",
    "mart_customer_months",
]


def _read_by(models: dict[str, Model], name: str) -> set[str]:
    """Tables of the layer below that a table is made from, also by way of its siblings."""
    model = models[name]
    return {*model.below}.union(*(_read_by(models, sibling) for sibling in model.beside))


def refresh_changes(
    warehouse: Warehouse,
    source: Tables,
    bronze: Iterable[str] = ROUTES,
    silver: Iterable[str] = ORDER_FACTS,
    gold: Iterable[str] = CAPTURED_MARTS,
    notes: dict[str, str] | None = None,
) -> None:
    """From changed source rows to bronze, silver and gold, current all at once.

    A table is recomputed in the months of what it reads: where refunds alone changed, lines
    and orders stay as they are. Dimensions and tables without a month are refreshed as a
    whole where they change.
    ``notes`` are kept with the result.
    """
    with warehouse.release() as release:
        for name, value in (notes or {}).items():
            release.note(name, value)
        below = capture_tables(release, source, names=list(bronze))
        orders = below.get("orders", set())
        every = {month for name, months in below.items() if ROUTES[name].date_column == "_order_date" for month in months}
        facts: dict[str, set[dt.date]] = {}
        for name in silver:
            read = [below[table] for table in _read_by(SILVER_MODELS, name) if table in below]
            facts[name] = set().union(*read) if read else every
            refresh_silver_months(release, release.layer("bronze"), facts[name], [name])
        carts = set().union(*(months for name, months in below.items() if ROUTES[name].date_column == "_cart_date"))
        carts = refresh_cart_months(release, release.layer("bronze"), carts, orders)
        for name in gold:
            months = set().union(*(facts[fact] for fact in _read_by(GOLD_MODELS, name) if fact in facts))
            refresh_months(release, release.layer("silver"), months, [name])
        refresh_months(release, release.layer("silver"), carts, ["mart_funnel_daily"], "cart_date")
        refresh_customers(release, orders)
