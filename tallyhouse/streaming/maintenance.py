"""Keeping gold up to date from a stream of changed orders.

A late refund changes the day of an old order, so appending results would be
wrong. Each micro-batch names the order months it touches, and those months are
recomputed from silver and replaced. Running a batch again gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.plans.incremental import (
    ORDER_FACTS,
    REVIEW_FACTS,
    refresh_months,
    refresh_silver_months,
    touched_months,
)
from tallyhouse.plans.medallion import REQUEST_MARTS, Tables
from tallyhouse.sources.warehouse import Warehouse


def maintain_gold(
    changes: DataFrame,
    warehouse: Warehouse,
    silver: Callable[[], Tables],
    checkpoint: str,
    names: Iterable[str] = REQUEST_MARTS,
) -> StreamingQuery:
    """Process all changes available now; ``changes`` has an ``order_date`` column.

    ``names`` are written marts by order month, each behind those it is made from.
    ``silver`` is called per batch, so each batch sees silver as it is then.
    """
    chosen = list(names)

    def replace_touched(batch: DataFrame, _: int) -> None:
        months = touched_months(batch)
        if months:
            refresh_months(warehouse, silver(), months, chosen)

    return (
        changes.select("order_date")
        .writeStream.foreachBatch(replace_touched)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def maintain_layers(
    changes: DataFrame,
    warehouse: Warehouse,
    bronze: Callable[[], Tables],
    checkpoint: str,
    facts: Iterable[str] = (*ORDER_FACTS, *REVIEW_FACTS),
    names: Iterable[str] = REQUEST_MARTS,
    stream: str = "orders",
) -> StreamingQuery:
    """Refresh silver, then gold, for the order months of each micro-batch.

    Both layers of a batch become current together, with the batch's number as a note.
    So a batch that ended half-way has changed nothing and is repeated whole, and one
    that was done when the stream died before it could say so is skipped. ``stream``
    tells the notes of several streams apart; it keeps its name and ``checkpoint``.
    """
    silver_names, gold_names = list(facts), list(names)
    ledger = f"batch of {stream}"

    def refresh(batch: DataFrame, number: int) -> None:
        done = warehouse.note(ledger)
        if done is not None and number <= int(done):
            return
        months = touched_months(batch)
        with warehouse.release() as release:
            if months:
                refresh_silver_months(release, bronze(), months, silver_names)
                refresh_months(release, release.layer("silver"), months, gold_names)
            release.note(ledger, str(number))

    return (
        changes.select("order_date")
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
