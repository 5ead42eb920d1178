"""Data-quality checks as Spark jobs.

Every check gives rows of ``table_name, column_name, check_name, severity,
failures, status``; ``failures`` is 0 when it holds. Keys are counted before
they are joined or compared, so one very frequent key is one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import count_if, totals

ERROR, WARN = "error", "warn"


def _result(
    counted: DataFrame, table: str, column: str, check: str, severity: str = ERROR
) -> DataFrame:
    """``counted`` has one row and one column: the number of failures."""
    failures = counted.columns[0]
    return counted.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.col(failures).cast("long").alias("failures"),
        F.when(F.col(failures) == 0, "pass").otherwise(severity).alias("status"),
    )


def all_of(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique(frame: DataFrame, table: str, *columns: str) -> DataFrame:
    """Failures: values (or combinations) that occur more than once. Nulls do not count."""
    keys = frame.select(*columns).na.drop()
    repeated = keys.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
    return _result(
        repeated.agg(F.count("*").alias("failures")), table, ",".join(columns), "unique"
    )


def not_null(frame: DataFrame, table: str, *columns: str) -> DataFrame:
    """Failures: null values, one row per column, all columns in one pass."""
    nulls = frame.agg(*[count_if(f"{column} is null", column) for column in columns])
    per_column = F.array(
        *[
            F.struct(F.lit(column).alias("column_name"), F.col(column).alias("failures"))
            for column in columns
        ]
    )
    return nulls.select(F.explode(per_column).alias("found")).select(
        F.lit(table).alias("table_name"),
        "found.column_name",
        F.lit("not_null").alias("check_name"),
        F.lit(ERROR).alias("severity"),
        "found.failures",
        F.when(F.col("found.failures") == 0, "pass").otherwise(ERROR).alias("status"),
    )


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Failures: child rows whose key is missing in the parent."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    orphans = keys.join(known, column, "left_anti")
    return _result(orphans.agg(*totals(["n"])), table, column, "relationships")


def accepted_values(
    frame: DataFrame, table: str, column: str, values: list, severity: str = ERROR
) -> DataFrame:
    """Failures: different values outside the list. Nulls do not count."""
    outside = frame.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*"))
    counted = outside.agg(F.count("*").alias("failures"))
    return _result(counted, table, column, "accepted_values", severity)


def holds(
    frame: DataFrame, table: str, column: str, check: str, rule: Column, severity: str = ERROR
) -> DataFrame:
    """Failures: rows where the rule is false. Unknown (null) does not count."""
    return _result(frame.agg(F.count_if(~rule).alias("failures")), table, column, check, severity)


def dropped(source: DataFrame, table: str, check: str, kept: Column) -> DataFrame:
    """Rows a silver filter leaves out, null conditions included."""
    out = ~F.coalesce(kept, F.lit(False))
    return _result(source.agg(F.count_if(out).alias("failures")), table, "*", check, WARN)


# -- arithmetic audits: the offending rows themselves ------------------------------


def order_total_mismatches(orders: DataFrame) -> DataFrame:
    """Orders whose total is not subtotal - discount + shipping + tax, at least 0."""
    due = F.greatest(
        F.col("subtotal_cents")
        - F.col("discount_cents")
        + F.col("shipping_cents")
        + F.col("tax_cents"),
        F.lit(0).cast("long"),
    )
    return orders.where(F.col("total_cents") != due).select(
        F.col("id").alias("order_id"), "total_cents", due.alias("expected_total_cents")
    )


def payment_mismatches(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments that are not the total of their order."""
    totals = orders.select(F.col("id").alias("order_id"), "total_cents")
    return (
        payments.join(totals, "order_id")
        .where("amount_cents <> total_cents")
        .select(F.col("id").alias("payment_id"), "order_id", "amount_cents", "total_cents")
    )


def coupon_mismatches(redemptions: DataFrame, coupons: DataFrame, orders: DataFrame) -> DataFrame:
    """Redemptions whose discount is not the coupon's, capped at the order's subtotal."""
    terms = coupons.select(F.col("id").alias("coupon_id"), "code", "discount_type", "discount_value")
    subtotals = orders.select(F.col("id").alias("order_id"), "subtotal_cents")
    percent = F.expr("(subtotal_cents * discount_value + 50) div 100")
    granted = F.when(F.col("discount_type") == "percent", percent).otherwise(
        F.col("discount_value")
    )
    return (
        redemptions.join(terms, "coupon_id")
        .join(subtotals, "order_id")
        .withColumn("expected_cents", F.least(granted, "subtotal_cents"))
        .where("discount_cents <> expected_cents")
        .select(
            F.col("id").alias("redemption_id"), "order_id", "code", "discount_cents", "expected_cents"
        )
    )
