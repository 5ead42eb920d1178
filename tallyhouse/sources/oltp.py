"""Reading the transactional source: over JDBC, or from exported files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.sources.schemas import BRONZE_SCHEMAS


@dataclass(frozen=True)
class Split:
    """How to read a table in parallel: a numeric or time column and its range.

    Rows outside the range are read too, by the first and the last task.
    """

    column: str
    lower: str
    upper: str
    parts: int


@dataclass(frozen=True)
class UuidSplit:
    """How to read a table keyed by UUIDs in parallel: equal ranges of the key."""

    column: str
    parts: int

    def predicates(self) -> list[str]:
        """One condition per task; each row meets exactly one, a null key the first."""
        bounds = [
            f"'{n * 16**8 // self.parts:08x}-0000-0000-0000-000000000000'"
            for n in range(1, self.parts)
        ]
        if not bounds:
            return ["1 = 1"]
        key = self.column
        between = [f"{key} >= {a} and {key} < {b}" for a, b in zip(bounds, bounds[1:])]
        return [f"{key} < {bounds[0]} or {key} is null", *between, f"{key} >= {bounds[-1]}"]


def typed(frame: DataFrame, name: str) -> DataFrame:
    """The declared columns of a source table, in their declared types."""
    declared = StructType.fromDDL(BRONZE_SCHEMAS[name])
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


# Lists that one task can read; other tables need a split, or to be named by the caller.
SMALL_TABLES = frozenset(["categories", "brands", "coupons", "warehouses", "payment_methods"])


@dataclass
class JdbcSource:
    """Tables of a database. Spark pushes column lists and filters into its queries."""

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, Split | UuidSplit] = field(default_factory=dict)
    schema: str = "public"
    fetch_rows: int = 10_000
    small: frozenset[str] = SMALL_TABLES

    def options(self, name: str) -> dict[str, str]:
        chosen = {
            "url": self.url,
            "dbtable": f"{self.schema}.{name}",
            "fetchsize": str(self.fetch_rows),
            **self.properties,
        }
        split = self.splits.get(name)
        if isinstance(split, Split):
            chosen.update(
                partitionColumn=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=str(split.parts),
            )
        return chosen

    def table(self, name: str) -> DataFrame:
        split = self.splits.get(name)
        if split is None and name not in self.small:
            # One task would read all of it over one connection.
            raise ValueError(f"{name} needs a split, or has to be named among the small tables")
        options = self.options(name)
        if isinstance(split, UuidSplit):
            url, table = options.pop("url"), options.pop("dbtable")
            rows = self.spark.read.jdbc(
                url, table, predicates=split.predicates(), properties=options
            )
        else:
            rows = self.spark.read.format("jdbc").options(**options).load()
        return typed(rows, name)


@dataclass
class FileSource:
    """Exported tables, one folder of files each, read with the declared schema."""

    spark: SparkSession
    folder: str
    file_format: str = "parquet"

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(BRONZE_SCHEMAS[name]).format(self.file_format)
        if self.file_format == "csv":
            reader = reader.option("header", True)
        return reader.load(f"{self.folder}/{name}")
