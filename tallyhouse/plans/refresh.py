"""Writes the layers in dependency order."""

from __future__ import annotations

from collections.abc import Iterable

from tallyhouse.operators.bronze import mirror
from tallyhouse.plans import data_tests
from tallyhouse.plans.data_tests import Check
from tallyhouse.plans.medallion import (
    GOLD_MODELS,
    SILVER_MODELS,
    Layer,
    Tables,
    gold_over,
    silver_over,
)
from tallyhouse.sources.schemas import BRONZE_TABLES
from tallyhouse.sources.warehouse import Release, Warehouse


def refresh_bronze(
    warehouse: Warehouse | Release, source: Tables, names: Iterable[str] = BRONZE_TABLES
) -> None:
    warehouse.create_databases()
    with warehouse.release() as release:
        for name in names:
            release.replace("bronze", name, mirror(source.table(name)))


def _refresh(
    warehouse: Warehouse | Release, layer_name: str, layer: Layer, names: Iterable[str]
) -> Layer:
    warehouse.create_databases()
    with warehouse.release() as release:
        for name in names:
            month_of = layer.models[name].month_of
            if layer.models[name].by:
                written = release.replace(layer_name, name, layer.parts(name), month_of)
            else:
                with layer.made(name) as frame:
                    written = release.replace(layer_name, name, frame, month_of)
            layer.use_written(name, written)
    return layer


def refresh_silver(
    warehouse: Warehouse | Release, names: Iterable[str] = SILVER_MODELS
) -> Layer:
    return _refresh(warehouse, "silver", silver_over(warehouse.layer("bronze")), names)


def refresh_gold(
    warehouse: Warehouse | Release, names: Iterable[str] = GOLD_MODELS, silver: Tables | None = None
) -> Layer:
    return refresh_marts(warehouse, gold_over(silver or warehouse.layer("silver")), names)


def refresh_marts(warehouse: Warehouse | Release, gold: Layer, names: Iterable[str]) -> Layer:
    return _refresh(warehouse, "gold", gold, names)


def refresh_all(
    warehouse: Warehouse, source: Tables, checks: Iterable[Check] | None = None
) -> None:
    """Source to bronze to silver to gold, everything anew, current all at once.

    With ``checks`` the new tables are tested first: if one of severity error fails, the
    refresh does too, and readers keep the old tables.
    """
    warehouse.create_databases()
    with warehouse.release() as release:
        refresh_bronze(release, source)
        refresh_silver(release)
        refresh_gold(release)
        if checks is not None:
            data_tests.run(release, checks)
