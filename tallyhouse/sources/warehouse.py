"""Written layers: one database per layer, one parquet table per model.

Every write makes a version of a table: a folder and a catalogue table of its own. Which
versions are current is the state, a small view that one statement replaces. So all
tables that a release wrote become current together, with its notes, or none does.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layer databases and the table name prefix inside each.
TABLE_PREFIX = {"bronze": "bronze_oltp__", "silver": "silver_", "gold": "gold_"}

# Between a table's name and its version's, and the property that names the current one.
VERSION = "__version_"
CURRENT = "tallyhouse.current"

# Two versions of a table lie side by side; keys and names made of text shrink well. Pages of
# version 2 keep differences of numbers and texts.
FILES = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.writer.version": "v2",
}

STATE_VIEW = "warehouse_state"
NOTE = "note"  # stands for a layer in the state's rows that are notes

# Date columns and the month partitions made of them. Those with an underscore are load
# columns of bronze tables, which also lie by month.
MONTH = {
    "order_date": "order_month",
    "cart_date": "cart_month",
    "review_date": "review_month",
    "_order_date": "_order_month",
    "_cart_date": "_cart_month",
}

State = dict[tuple[str, str], str]


def with_month(frame: DataFrame, date_column: str) -> DataFrame:
    return frame.withColumn(MONTH[date_column], F.trunc(date_column, "MM"))


def in_months(column: str, months: Iterable[dt.date | None]) -> Column:
    """Whether a month is one of the given, None standing for a missing one."""
    chosen = F.col(column).isin(sorted(month for month in months if month))
    return chosen | F.col(column).isNull() if None in months else chosen


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Warehouse:
    """Full-refresh and partition-refresh writes, and scans, under one root folder.

    ``qualifier`` keeps several warehouses apart in one catalogue; without it the
    databases are simply called bronze, silver and gold. One release is written at a
    time; readers may come and go.
    """

    def __init__(self, spark: SparkSession, root: str, qualifier: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.qualifier = qualifier

    def database(self, layer: str) -> str:
        if layer not in TABLE_PREFIX:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.qualifier}{layer}"

    def full_name(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{TABLE_PREFIX[layer]}{name}"

    def create_databases(self) -> None:
        for layer in TABLE_PREFIX:
            database = self.database(layer)
            self.spark.sql(
                f"create database if not exists {database} location '{self.root}/{database}'"
            )

    # -- state ----------------------------------------------------------------

    def state(self) -> State:
        """Current versions by layer and name, and notes: a short list, read at once."""
        view = f"{self.database('gold')}.{STATE_VIEW}"
        if not self.spark.catalog.tableExists(view):
            return {}
        return {(row["layer"], row["name"]): row["value"] for row in self.spark.table(view).collect()}

    def snapshot(self) -> Snapshot:
        """All tables as they are now. Later releases don't change what it hands out."""
        return Snapshot(self.spark, self.state())

    def current(self, layer: str, name: str) -> str:
        """The version a table's name points to."""
        found = self.state().get((layer, name))
        if found is None:
            raise KeyError(f"{self.full_name(layer, name)} has not been written")
        return found

    def note(self, name: str) -> str | None:
        """What the last release that spoke of ``name`` noted."""
        return self.state().get((NOTE, name))

    # -- writes ---------------------------------------------------------------

    @contextmanager
    def release(self) -> Iterator[Release]:
        """Tables written within become current together at the end, if nothing failed.

        The state is switched by one statement. The plain names of the tables, for SQL,
        follow one by one right after; who reads several tables that have to fit
        together takes a ``snapshot``.
        """
        made = Release(self)
        yield made
        made.publish()

    def replace(
        self, layer: str, name: str, frame: DataFrame | Sequence[DataFrame], month_of: str | None = None
    ) -> DataFrame:
        """Full refresh of one table, a release of its own."""
        with self.release() as release:
            release.replace(layer, name, frame, month_of)
        return self.table(layer, name)

    def replace_months(
        self, layer: str, name: str, frame: DataFrame, month_of: str, months: Iterable[dt.date]
    ) -> DataFrame:
        """Refresh of some months of one table, a release of its own."""
        with self.release() as release:
            release.replace_months(layer, name, frame, month_of, months)
        return self.table(layer, name)

    def folder(self, layer: str, name: str, version: str) -> str:
        return f"{self.root}/{self.database(layer)}/{name}/{version.rsplit(VERSION, 1)[1]}"

    def places(self, layer: str, name: str, version: str) -> dict[dt.date | None, str]:
        """The folder of each month of a version: as many as the calendar has."""
        rows = self.spark.read.schema("month date, place string").parquet(
            f"{self.folder(layer, name, version)}.months"
        )
        return {row["month"]: row["place"] for row in rows.collect()}

    def expire(self, layer: str, name: str) -> list[str]:
        """Take versions that nothing needs any more out of the catalogue.

        Returns their folders, which the storage may delete. A version stays as long as it
        is current, or the current one has months in its folder. Snapshots taken
        before a release must be done with.
        """
        current, folders = self.current(layer, name), []
        database, table = self.full_name(layer, name).rsplit(".", 1)
        used = {self.folder(layer, name, current)}
        if any(month in self.spark.table(current).columns for month in MONTH.values()):
            used |= {place.rsplit("/", 1)[0] for place in self.places(layer, name, current).values()}
        for row in self.spark.sql(f"show tables in {database} like '{table}{VERSION}*'").collect():
            folder = self.folder(layer, name, row["tableName"])
            if folder not in used:
                folders.append(folder)
                self.spark.sql(f"drop table {database}.{row['tableName']}")
        return folders

    # -- reads ----------------------------------------------------------------

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.full_name(layer, name))

    def layer(self, layer: str) -> WrittenLayer:
        return WrittenLayer(self, layer)


class Snapshot:
    """Tables of one state of the warehouse."""

    def __init__(self, spark: SparkSession, state: State):
        self.spark = spark
        self.state = state

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.state[layer, name])

    def layer(self, layer: str) -> WrittenLayer:
        return WrittenLayer(self, layer)


class Release:
    """Versions that are written but not current yet, over the state they began from.

    Reads see what the release has written, and all other tables as they were at its
    beginning. It has the methods of a warehouse that refreshes use.
    """

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.before = warehouse.state()
        self.staged: State = {}

    @property
    def spark(self) -> SparkSession:
        return self.warehouse.spark

    def create_databases(self) -> None:
        self.warehouse.create_databases()

    @contextmanager
    def release(self) -> Iterator[Release]:
        """A part of this release; nothing becomes current before its end."""
        yield self

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table({**self.before, **self.staged}[layer, name])

    def was(self, layer: str, name: str) -> DataFrame:
        """A table as it was at the beginning."""
        return self.spark.table(self.before[layer, name])

    def layer(self, layer: str) -> WrittenLayer:
        return WrittenLayer(self, layer)

    def note(self, name: str, value: str) -> None:
        """Keep a line with the state: it is there if and only if the tables are."""
        self.staged[NOTE, name] = value

    def replace(
        self, layer: str, name: str, frame: DataFrame | Sequence[DataFrame], month_of: str | None = None
    ) -> DataFrame:
        """A whole new version, of one frame or of several written one after the other.

        Month partitions are rebalanced before the write: Spark splits a month
        that holds most rows over several tasks and merges tiny ones. Tables
        without months are written as they come, without a shuffle for it.
        """
        version, folder = self._new_version(layer, name)
        frames = [frame] if isinstance(frame, DataFrame) else frame
        if month_of:
            frames = [with_month(frame, month_of) for frame in frames]
            self._month_table(layer, name, version, frames[0].schema, MONTH[month_of],
                              self._written_months(frames, MONTH[month_of], folder))
        else:
            for frame in frames:
                frame.write.mode("append").options(**FILES).parquet(folder)
            self.spark.sql(f"create table {version} using parquet location '{folder}'")
        self.staged[layer, name] = version
        return self.spark.table(version)

    def replace_months(
        self, layer: str, name: str, frame: DataFrame, month_of: str, months: Iterable[dt.date | None]
    ) -> DataFrame:
        """A new version with the given months from ``frame``, the others as they are.

        Only the given months are written (None: the rows without a date); the version's other
        partitions point to the files that hold them already. The rows may come from the
        table itself. A month that has no rows any more has no partition in the new
        version.
        """
        wanted, month = set(months), MONTH[month_of]
        old = {**self.before, **self.staged}[layer, name]
        version, folder = self._new_version(layer, name)
        schema = self.spark.table(old).schema
        frame = with_month(frame, month_of).where(in_months(month, wanted)).to(schema)
        places = {m: place for m, place in self.warehouse.places(layer, name, old).items() if m not in wanted}
        self._month_table(layer, name, version, schema, month, places | self._written_months([frame], month, folder))
        self.staged[layer, name] = version
        return self.spark.table(version)

    def publish(self) -> None:
        """Make what is written current: the state by one statement, then the names."""
        if not self.staged:
            return
        rows = ", ".join(
            f"({_quoted(layer)}, {_quoted(name)}, {_quoted(value)})"
            for (layer, name), value in sorted({**self.warehouse.state(), **self.staged}.items())
        )
        self.spark.sql(
            f"create or replace view {self.warehouse.database('gold')}.{STATE_VIEW}"
            f" as select * from values {rows} as state(layer, name, value)"
        )
        for (layer, name), version in self.staged.items():
            if layer != NOTE:
                self.spark.sql(
                    f"create or replace view {self.warehouse.full_name(layer, name)}"
                    f" tblproperties ('{CURRENT}' = '{version}') as select * from {version}"
                )

    def _new_version(self, layer: str, name: str) -> tuple[str, str]:
        version = f"{self.warehouse.full_name(layer, name)}{VERSION}{uuid.uuid4().hex}"
        return version, self.warehouse.folder(layer, name, version)

    def _written_months(self, frames: Sequence[DataFrame], month: str, folder: str) -> dict[dt.date | None, str]:
        """Write rows by month; the folder of each month that has any."""
        for frame in frames:
            by_month = frame.hint("rebalance", month).write.mode("append").partitionBy(month)
            by_month.options(**FILES).parquet(folder)
        # The declared schema also covers a folder without any row.
        rows = self.spark.read.schema(frames[0].schema).parquet(folder).select(month).distinct()
        none = "__HIVE_DEFAULT_PARTITION__"
        return {row[0]: f"{folder}/{month}={row[0] or none}" for row in rows.collect()}

    def _month_table(
        self,
        layer: str,
        name: str,
        version: str,
        schema: T.StructType,
        month: str,
        places: dict[dt.date | None, str],
    ) -> None:
        """A catalogue table whose partitions lie at the given places."""
        folder = self.warehouse.folder(layer, name, version)
        kept = self.spark.createDataFrame([*places.items()], "month date, place string")
        kept.coalesce(1).write.parquet(f"{folder}.months")
        self.spark.sql(
            f"create table {version} ({schema.toDDL()}) using parquet partitioned by ({month}) location '{folder}'"
        )
        if places:
            parts = " ".join(
                f"partition ({month} = {f"date '{m}'" if m else 'null'}) location '{place}'"
                for m, place in places.items()
            )
            self.spark.sql(f"alter table {version} add {parts}")


class WrittenLayer:
    """Written tables of one layer by model name."""

    def __init__(self, warehouse: Warehouse | Release | Snapshot, layer: str):
        self.warehouse = warehouse
        self.name = layer

    def table(self, name: str) -> DataFrame:
        return self.warehouse.table(self.name, name)
