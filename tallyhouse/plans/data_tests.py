"""All data tests of a warehouse in few passes, and a runner that acts on them.

Checks are declared; ``outcomes`` turns those of a table into one aggregate for all its
row rules and one grouping-sets aggregate for all its keys, so a table is read twice at
most, however many checks it has.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import facts
from tallyhouse.operators.quality import ERROR, WARN, all_of
from tallyhouse.plans import quality_suite as suite
from tallyhouse.plans.medallion import Tables
from tallyhouse.sources.warehouse import Release, Warehouse

RESULTS = "test_results"


@dataclass(frozen=True)
class Check:
    """One data test of a column (or several) of a table.

    Either ``fails`` is a condition of failing rows (SQL text needs no session yet), or ``key`` names columns whose values
    are tested: for being there once, for being among ``values``, or for being
    a key of ``parent`` (layer, table, column).
    """

    layer: str
    table: str
    column: str
    name: str
    severity: str = ERROR
    fails: Column | str | None = None
    key: tuple[str, ...] = ()
    values: tuple[object, ...] = ()
    parent: tuple[str, str, str] | None = None


def unique(layer: str, table: str, *columns: str) -> Check:
    """Failures: values (or combinations) that occur more than once; nulls do not count."""
    return Check(layer, table, ",".join(columns), "unique", key=columns)


def not_null(layer: str, table: str, column: str) -> Check:
    return Check(layer, table, column, "not_null", fails=f"{column} is null")


def related(layer: str, table: str, column: str, parent: tuple[str, str, str]) -> Check:
    """Failures: rows whose key is missing in the parent."""
    return Check(layer, table, column, "relationships", key=(column,), parent=parent)


def accepted(layer: str, table: str, column: str, values: Sequence[object], severity: str = ERROR) -> Check:
    """Failures: different values outside the list; nulls do not count."""
    return Check(layer, table, column, "accepted_values", severity, key=(column,), values=tuple(values))


def _not(rule: Column | str) -> Column | str:
    return f"not ({rule})" if isinstance(rule, str) else ~rule


def holds(layer: str, table: str, column: str, name: str, rule: Column | str, severity: str = ERROR) -> Check:
    """Failures: rows where the rule is false; unknown does not count."""
    return Check(layer, table, column, name, severity, fails=_not(rule))


def kept(layer: str, table: str, name: str, rule: Column | str) -> Check:
    """Rows that a filter leaves out, those with unknown conditions included."""
    fails = f"not coalesce({rule}, false)" if isinstance(rule, str) else ~F.coalesce(rule, F.lit(False))
    return Check(layer, table, "*", name, WARN, fails=fails)


def standard_checks() -> list[Check]:
    """The checks of the layers that ``plans.quality_suite`` lists one by one."""
    silver = [("silver", t, c) for t, columns in suite.SILVER_KEYS.items() for c in columns]
    needed = [("silver", t, c) for t, columns in suite.SILVER_REQUIRED.items() for c in columns]
    in_range = F.col("rating").between(suite.RATINGS[0], suite.RATINGS[-1])
    paid_in = F.col("amount_cents") >= 0
    return [
        *(unique(*key) for key in silver),
        unique("gold", "mart_daily_sales", "order_date"),
        unique("gold", "mart_product_sales", "order_date", "product_id"),
        *(not_null(*column) for column in needed),
        not_null("gold", "mart_daily_sales", "order_date"),
        not_null("gold", "mart_product_sales", "order_date"),
        not_null("gold", "mart_product_sales", "product_id"),
        related("silver", "dim_variants", "product_id", ("silver", "dim_products", "product_id")),
        related("silver", "fct_order_items", "order_id", ("silver", "fct_orders", "order_id")),
        related("silver", "fct_order_items", "variant_id", ("silver", "dim_variants", "variant_id")),
        related("bronze", "refunds", "payment_id", ("bronze", "payments", "id")),
        related("bronze", "product_reviews", "product_id", ("bronze", "products", "id")),
        related("bronze", "order_items", "variant_id", ("bronze", "product_variants", "id")),
        accepted("silver", "fct_orders", "order_status", suite.ORDER_STATUSES),
        accepted("silver", "fct_payments", "payment_status", suite.PAYMENT_STATUSES, WARN),
        accepted("silver", "fct_reviews", "rating", suite.RATINGS),
        holds("bronze", "product_reviews", "rating", "between_1_and_5", in_range),
        unique("bronze", "cart_items", "cart_id", "variant_id"),
        unique("bronze", "inventory_levels", "warehouse_id", "variant_id"),
        *(unique("bronze", table, column) for table, column in suite.NATURAL_KEYS),
        holds("bronze", "users", "email", "looks_like_email", F.col("email").rlike(suite.EMAIL), WARN),
        holds("bronze", "product_reviews", "rating", "between_1_and_5", in_range, WARN),
        *(
            holds("bronze", table, "quantity", "positive", F.col("quantity") > 0, WARN)
            for table in ("order_items", "cart_items", "return_items")
        ),
        kept("bronze", "orders", "valid_order", facts.valid_order()),
        kept("bronze", "order_items", "valid_line", facts.valid_line()),
        kept("bronze", "payments", "not_negative", paid_in),
        kept("bronze", "refunds", "not_negative", paid_in),
        kept("bronze", "inventory_levels", "valid_stock", facts.valid_stock()),
        kept("bronze", "product_reviews", "valid_rating", facts.valid_rating()),
    ]


def _row_rules(frame: DataFrame, rules: dict[int, Column | str]) -> DataFrame:
    """(check, failures) of all row rules of a table, in one aggregate."""
    counts = frame.agg(*(F.count_if(F.expr(rule) if isinstance(rule, str) else rule).alias(f"c{number}") for number, rule in rules.items()))
    found = [F.struct(F.lit(number).alias("check"), F.col(f"c{number}").alias("failures")) for number in rules]
    return counts.select(F.explode(F.array(*found)).alias("x")).select("x.*")


def _key_counts(frame: DataFrame, keys: list[tuple[str, ...]]) -> DataFrame:
    """(place in keys, key as text, n) of all keys of a table, in one shuffle.

    A key is one row from here on, however many rows have it. Those with a null are left out.
    """
    columns = sorted({column for key in keys for column in key})
    # Tells the sets apart: a bit for each column that is not in the set.
    bits = {
        sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key): place
        for place, key in enumerate(keys)
    }
    counted = frame.select(*columns).groupingSets([[F.col(c) for c in key] for key in keys], *map(F.col, columns)).agg(
        F.grouping_id().alias("set"), F.count("*").alias("n")
    )
    place, text, whole = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(False)
    for bit, at in bits.items():
        key = keys[at]
        own = F.col("set") == bit
        spelled = F.col(key[0]).cast("string") if len(key) == 1 else F.to_json(F.struct(*key))
        place, text = F.when(own, at).otherwise(place), F.when(own, spelled).otherwise(text)
        nulls = [F.col(column).isNotNull() for column in key]
        there = nulls[0]
        for other in nulls[1:]:
            there = there & other
        whole = F.when(own, there).otherwise(whole)
    return counted.where(whole).select(place.alias("place"), text.alias("key"), "n")


def _key_sides(
    counted: DataFrame, at: tuple[str, str], keys: list[tuple[str, ...]], checks: Sequence[Check]
) -> DataFrame:
    """(check, key, rows, known): what the keys of a table mean to each check.

    A key that fails by itself is a row without its key; for relationships, child keys bring
    their rows and parent keys the news that they are known. All checks take them from
    one pass over the counted keys.
    """
    meanings = []

    def means(number: int, key: tuple[str, ...], bad: Column | None, rows: Column, text: Column, known: bool) -> None:
        here = F.col("place") == keys.index(key)
        row = F.struct(
            F.lit(number).alias("check"), text.alias("key"), rows.cast("long").alias("rows"), F.lit(known).alias("known")
        )
        meanings.append(F.when(here if bad is None else here & bad, row))

    nothing = F.lit(None).cast("string")
    for number, check in enumerate(checks):
        if check.parent and check.parent[:2] == at:
            means(number, (check.parent[2],), None, F.lit(0), F.col("key"), True)
        if check.fails is not None or (check.layer, check.table) != at:
            continue
        if check.parent:
            means(number, check.key, None, F.col("n"), F.col("key"), False)
        elif check.values:
            means(number, check.key, ~F.col("key").isin([str(v) for v in check.values]), F.lit(1), nothing, False)
        else:
            means(number, check.key, F.col("n") > 1, F.lit(1), nothing, False)
    each = F.explode(F.filter(F.array(*meanings), lambda x: x.isNotNull()))
    return counted.select(each.alias("x")).select("x.*")


def outcomes(layers: dict[str, Tables], checks: Sequence[Check]) -> DataFrame:
    """table_name, column_name, check_name, severity, failures and status of each check."""
    found: list[DataFrame] = []
    rules: dict[tuple[str, str], dict[int, Column | str]] = {}
    keys: dict[tuple[str, str], list[tuple[str, ...]]] = {}

    def add_key(layer: str, table: str, key: tuple[str, ...]) -> None:
        held = keys.setdefault((layer, table), [])
        if key not in held:
            held.append(key)

    for number, check in enumerate(checks):
        if check.fails is not None:
            rules.setdefault((check.layer, check.table), {})[number] = check.fails
        else:
            add_key(check.layer, check.table, check.key)
        if check.parent:
            layer, table, column = check.parent
            add_key(layer, table, (column,))
    for (layer, table), own in rules.items():
        found.append(_row_rules(layers[layer].table(table), own))
    sides = [
        _key_sides(_key_counts(layers[at[0]].table(at[1]), own), at, own, checks)
        for at, own in keys.items()
    ]
    if sides:
        met = all_of(sides).groupBy("check", "key").agg(F.sum("rows").alias("rows"), F.bool_or("known").alias("known"))
        failing = F.when(~F.col("known"), F.col("rows")).otherwise(0)
        found.append(met.groupBy("check").agg(F.sum(failing).alias("failures")))
    named = [
        F.struct(
            F.lit(number).alias("check"),
            F.lit(f"{check.layer}_{check.table}").alias("table_name"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
        )
        for number, check in enumerate(checks)
    ]
    listed = found[0].sparkSession.range(1).select(F.explode(F.array(*named)).alias("x")).select("x.*")
    counts = all_of([frame.select("check", F.col("failures").cast("long").alias("failures")) for frame in found])
    return (
        listed.join(counts, "check", "left")
        .na.fill(0, ["failures"])
        .select(
            "table_name",
            "column_name",
            "check_name",
            "severity",
            "failures",
            F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status"),
        )
    )


def outcomes_by_table(layers: dict[str, Tables], checks: Sequence[Check]) -> DataFrame:
    """``outcomes`` of one tested table after the other, one row a check.

    Keys of all tables shuffled at once would lie on the disks side by side.
    """
    tables: dict[tuple[str, str], list[Check]] = {}
    for check in checks:
        tables.setdefault((check.layer, check.table), []).append(check)
    frames = [outcomes(layers, own) for own in tables.values()]
    rows = [tuple(row) for frame in frames for row in frame.collect()]
    return frames[0].sparkSession.createDataFrame(rows, frames[0].schema)


class DataTestError(Exception):
    """Checks of severity ``error`` that failed."""

    def __init__(self, failed: list[str]):
        super().__init__("; ".join(failed))
        self.failed = failed


def run(
    tables: Warehouse | Release,
    checks: Iterable[Check] | None = None,
    keep: bool = True,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Test written tables, keep what was found, and fail on errors.

    Inside a release its new versions are tested before they are current, so an error
    leaves readers with the old tables; the results are kept in any case, as
    rows of ``gold.test_results`` with the run's id and instant. Warnings only show there.
    """
    chosen = list(standard_checks() if checks is None else checks)
    layers = {layer: tables.layer(layer) for layer in {c.layer for c in chosen} | {c.parent[0] for c in chosen if c.parent}}
    # One row a check.
    rows = outcomes_by_table(layers, chosen).collect()
    spark = tables.spark
    run_id, moment = uuid.uuid4().hex, now or dt.datetime.now(dt.timezone.utc)
    result = spark.createDataFrame(
        [(run_id, moment, *row) for row in rows],
        "run_id string, tested_at timestamp, table_name string, column_name string, check_name string,"
        " severity string, failures long, status string",
    )
    if keep:
        warehouse = tables.warehouse if isinstance(tables, Release) else tables
        earlier = warehouse.state().get(("gold", RESULTS))
        whole = spark.table(earlier).unionByName(result) if earlier else result
        warehouse.replace("gold", RESULTS, whole)
    failed = [
        f"{row.table_name}.{row.column_name} {row.check_name}: {row.failures}"
        for row in rows
        if row.status == ERROR
    ]
    if failed:
        raise DataTestError(failed)
    return result
