"""Column expressions shared by all layers. Built-ins only, so plans stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_lower(value: ColumnLike) -> Column:
    """Statuses and slugs: no outer blanks, lower case."""
    return F.lower(F.trim(_col(value)))


def clean_upper(value: ColumnLike) -> Column:
    """Codes (currency, SKU): no outer blanks, upper case."""
    return F.upper(F.trim(_col(value)))


def blank_to_null(value: ColumnLike) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(_col(value)), F.lit(""))


def slug(value: ColumnLike) -> Column:
    """Lower case, every run of other characters one hyphen, none at the ends."""
    hyphenated = F.regexp_replace(F.lower(_col(value)), "[^a-z0-9]+", "-")
    return F.regexp_replace(hyphenated, "^-|-$", "")


def day_of_week0(day: ColumnLike) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(day)) - 1


def hours_crossed(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of hour boundaries between two instants (10:59 to 11:01 is 1)."""

    def hour_number(instant: ColumnLike) -> Column:
        return F.unix_seconds(F.date_trunc("HOUR", _col(instant)))

    # Both numbers are whole hours, so the division leaves no remainder.
    return ((hour_number(end) - hour_number(start)) / 3600).cast("long")


# The numeric helpers below take and give SQL text, so that whole formulas reach
# Spark as one expression; ``F.expr``, ``agg`` helpers and ``selectExpr`` use it.


def half_up(value: str, digits: int = 0) -> str:
    """Round halves towards plus infinity, as a browser's Math.round does."""
    if digits == 0:
        return f"floor(({value}) + 0.5D)"
    scale = 10**digits
    return f"floor(({value}) * {scale}D + 0.5D) / {scale}D"


def ratio(numerator: str, denominator: str, empty: str = "null") -> str:
    """numerator / denominator as double, ``empty`` unless the denominator is positive."""
    return (
        f"case when {denominator} > 0 then double({numerator}) / {denominator}"
        f" else double({empty}) end"
    )


def percent(part: str, whole: str) -> str:
    """Part of the whole in percent, two digits; 0 unless the whole is positive."""
    return half_up(f"({ratio(part, whole, '0')}) * 100", 2)


def allocated_share(amount: str, part: str, whole: str) -> str:
    """The whole-cent share of ``amount`` for ``part`` of ``whole``.

    Each share is rounded on its own and nothing is rebalanced, so the shares
    of one amount may add up to a cent more or less.
    """
    return (
        f"case when {whole} > 0 then bigint(round({amount} * (double({part}) / {whole})))"
        " else 0L end"
    )


def dollars(cents: str) -> str:
    return half_up(f"{cents} / 100", 2)


def shortened(text: str, longest: int, kept: int) -> str:
    """Chart label: ``kept`` characters and an ellipsis when longer than ``longest``."""
    return (
        f"case when char_length({text}) > {longest} then concat(left({text}, {kept}), '…')"
        f" else {text} end"
    )


def total(value: str) -> str:
    """Sum that is 0 on no rows."""
    return f"bigint(coalesce(sum({value}), 0))"


def mean_rating() -> str:
    """Mean over reviews from rows that hold a mean and a count of reviews.

    A mean times its count is summed as a decimal, so that the result does not depend on
    the order of rows.
    """
    return ratio("sum(cast(avg_rating * review_count as decimal(28,6)))", "sum(review_count)")


def totals(columns: Iterable[str]) -> list[Column]:
    """``total`` of each column under its own name."""
    return [F.expr(f"{total(column)} as {column}") for column in columns]


def count_if(condition: str, name: str) -> Column:
    return F.expr(f"count_if({condition}) as {name}")
