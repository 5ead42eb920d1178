"""Bronze: the source as it is, with a note of when and where it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD_COLUMNS = ["_loaded_at", "_source_system"]


def mirror(source: DataFrame, source_system: str = "oltp") -> DataFrame:
    """All rows and columns, plus load metadata."""
    return source.withColumn("_loaded_at", F.current_timestamp()).withColumn(
        "_source_system", F.lit(source_system)
    )
