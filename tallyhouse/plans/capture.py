"""Incremental bronze: changed source rows, kept by the month of their order or cart.

A high-water mark per table tells what changed since. Rows of lines, payments and the
like carry no order date of their own, so they are routed by a narrow index from orders
to dates, the bronze orders themselves. With bronze kept so, refreshing a month of
silver reads that month's partitions alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.bronze import mirror
from tallyhouse.operators.joins import join_grouped
from tallyhouse.plans.medallion import Tables
from tallyhouse.session import shared_folder
from tallyhouse.sources.warehouse import MONTH, NOTE, Release, Warehouse, in_months


@dataclass(frozen=True)
class Route:
    """How a table's rows find their date and how a changed row is known.

    ``key`` of a row is the id of a row of ``parent``, whose date it takes; without a parent
    ``date`` is an expression of the row itself. ``changed`` is when a row last changed.
    Without that the rows change with their parent, all rows of a changed one together.
    """

    date_column: str
    parent: str | None = None
    key: str = "id"
    date: str | None = None
    changed: str | None = None


# Parents first.
ROUTES = {
    "orders": Route("_order_date", date="to_date(placed_at)", changed="updated_at"),
    "order_items": Route("_order_date", "orders", "order_id"),
    "payments": Route("_order_date", "orders", "order_id", changed="greatest(created_at, paid_at)"),
    "shipments": Route(
        "_order_date", "orders", "order_id", changed="greatest(created_at, shipped_at, delivered_at)"
    ),
    "returns": Route("_order_date", "orders", "order_id", changed="greatest(requested_at, resolved_at)"),
    "coupon_redemptions": Route("_order_date", "orders", "order_id", changed="redeemed_at"),
    "refunds": Route("_order_date", "payments", "payment_id", changed="greatest(created_at, refunded_at)"),
    "return_items": Route("_order_date", "returns", "return_id"),
    "carts": Route("_cart_date", date="to_date(created_at)", changed="updated_at"),
    "cart_items": Route("_cart_date", "carts", "cart_id"),
}


def _routed(rows: DataFrame, route: Route, dates: DataFrame | None) -> DataFrame:
    """Rows with their date; one whose parent is unknown has none."""
    rows = rows.drop(route.date_column, MONTH[route.date_column])
    if route.parent is None:
        return rows.withColumn(route.date_column, F.expr(route.date))
    found = dates.select(F.col("id").alias(route.key), route.date_column)
    return join_grouped(rows, found, route.key, "left").select(*rows.columns, route.date_column)


def load(warehouse: Warehouse | Release, source: Tables, names: Iterable[str] = ROUTES) -> None:
    """All rows of the given tables, by month, and where their changes begin."""
    warehouse.create_databases()
    with warehouse.release() as release:
        for name in names:
            route = ROUTES[name]
            dates = release.table("bronze", route.parent) if route.parent else None
            rows = _routed(mirror(source.table(name)), route, dates)
            release.replace("bronze", name, rows, route.date_column)
            _note_mark(release, name, release.table("bronze", name))


def _note_mark(release: Release, name: str, rows: DataFrame) -> None:
    if ROUTES[name].changed:
        last = rows.agg(F.expr(f"cast(max({ROUTES[name].changed}) as string)")).first()[0]
        if last is not None:
            release.note(f"changed {name}", last)


def _months(rows: DataFrame, date_column: str) -> set[dt.date | None]:
    """Months of rows: a calendar has few."""
    return {row[0] for row in rows.select(F.trunc(date_column, "MM")).distinct().collect()}


def _repeated(rows: DataFrame, date_column: str) -> set[dt.date | None]:
    """Months of rows whose id comes twice: what is below them meets each of them, so it is written."""
    ids = rows.groupBy("id").count().where("count > 1")
    return _months(rows.select("id", date_column).join(ids, "id", "left_semi"), date_column)


def capture(
    warehouse: Warehouse | Release,
    source: Tables,
    overlap: dt.timedelta = dt.timedelta(hours=1),
    names: Iterable[str] = ROUTES,
) -> dict[str, set[dt.date | None]]:
    """``capture_tables``, but the touched months of orders and of carts by date column."""
    touched: dict[str, set[dt.date | None]] = {}
    for name, months in capture_tables(warehouse, source, overlap, names).items():
        touched.setdefault(ROUTES[name].date_column, set()).update(months)
    return touched


def capture_tables(
    warehouse: Warehouse | Release,
    source: Tables,
    overlap: dt.timedelta = dt.timedelta(hours=1),
    names: Iterable[str] = ROUTES,
) -> dict[str, set[dt.date | None]]:
    """Bring bronze up to date with rows changed since the last time.

    Rows are taken from the high-water mark less ``overlap``, since transactions may end
    out of order; taking a row twice changes nothing. Rows keep their parent. An order that moved to another
    day takes its rows along, and rows that came before their order find it later.
    Rows deleted at the source stay, but for those of a table without an instant of
    its own, until the next ``load``. The marks are notes of the release, so that a failed
    run takes the same rows again. A table is written in the months of its changed rows and
    in those its parent is written in; the others stay as they are. Returns the months by table.
    """
    shared_folder(warehouse.spark)
    touched: dict[str, set[dt.date | None]] = {}
    own: dict[str, set[dt.date | None]] = {}
    written: dict[str, set[dt.date | None]] = {}
    repeated: dict[str, set[dt.date | None]] = {}  # by parent
    names = list(names)
    with warehouse.release() as release:
        changed: dict[str, DataFrame] = {}
        for name in names:
            route = ROUTES[name]
            rows = source.table(name)
            if route.changed:
                mark = release.before.get((NOTE, f"changed {name}"))
                if mark is not None:
                    since = dt.datetime.fromisoformat(mark) - overlap
                    rows = rows.where(f"{route.changed} >= timestamp '{since}'")
            else:
                parents = changed[route.parent].select(F.col("id").alias(route.key))
                rows = rows.join(parents, route.key, "left_semi").select(*rows.columns)
            changed[name] = mirror(rows).checkpoint()  # read once from the source
        # Dates of changed rows as they were and as they will be tell the months to write.
        known: dict[str, DataFrame] = {}
        for name, rows in changed.items():
            route = ROUTES[name]
            column = route.date_column
            old = release.table("bronze", name).select("id", column)
            fresh = _routed(rows, route, known.get(route.parent)).select("id", column)
            months = own[name] = _months(fresh, column)
            if route.parent is None:
                # A row with a parent lies where that one's old month is.
                months |= _months(old.join(fresh.select("id").distinct(), "id", "left_semi"), column)
            touched.setdefault(column, set()).update(months)
            if any(ROUTES[other].parent == name for other in names):
                kept = old.join(fresh.select("id").distinct(), "id", "left_anti")
                known[name] = kept.unionByName(fresh)
        for name, rows in changed.items():
            route = ROUTES[name]
            column = route.date_column
            key = "id" if route.changed else route.key
            months = own[name] | written.get(route.parent, set())
            if route.parent and route.parent not in repeated:
                parents = release.table("bronze", route.parent)
                parents = parents.where(in_months(MONTH[column], touched[column] | {None}))
                repeated[route.parent] = _repeated(parents, column)
            months = months | repeated.get(route.parent, set())
            written[name] = months
            if not months:
                continue
            months = months | {None}
            old = release.table("bronze", name).where(in_months(MONTH[column], months))
            kept = old.drop(MONTH[column], column).join(rows.select(key).distinct(), key, "left_anti")
            both = kept.unionByName(rows.select(*kept.columns))
            dates = None
            if route.parent:  # of the same months: the parents' dates are up to date by now
                dates = release.table("bronze", route.parent).where(in_months(MONTH[column], months))
            release.replace_months("bronze", name, _routed(both, route, dates), column, months)
            _note_mark(release, name, rows)
    return {name: months - {None} for name, months in written.items()}
