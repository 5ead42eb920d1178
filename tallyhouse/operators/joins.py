"""Joins that stay splittable when one key holds a large part of the rows, and joins in parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tables of more rows are joined in parts of this many, or in an eighth of them.
ROWS_A_PART = 30_000_000
PARTS = 8


def join_grouped(many: DataFrame, grouped: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to the one row their key has in a frame grouped by that key.

    AQE splits a hot key only in a join whose two inputs are both shuffled for
    it. A frame grouped by the key is in place already, would not be shuffled
    again, and the hot key would stay in one task. A second key, the hash of the
    first, asks for a shuffle of both. Where the grouped side turns out small,
    AQE broadcasts it instead.
    """
    digest = F.xxhash64(key)
    return (
        many.withColumn("_digest", digest)
        .join(grouped.withColumn("_digest", digest), [key, "_digest"], how)
        .drop("_digest")
    )


def joined_in_parts(sides: Sequence[tuple[DataFrame, str]]) -> list[list[DataFrame]]:
    """The sides of a join, each with its key, cut into parts whose rows meet no others.

    The shuffle files of a part are gone before the next one is joined and written. Rows fall
    to a part by the hash of their key alone, so the joined parts stacked are the joined
    sides; keys of unlike types would not hash alike and are left whole. Rows of the first side
    are counted. Each part reads all sides anew.
    """
    whole = [side for side, _ in sides]
    if len({side.schema[key].dataType for side, key in sides}) > 1:
        return [whole]
    parts = min(PARTS, -(-whole[0].count() // ROWS_A_PART))
    if parts < 2:
        return [whole]
    return [
        [side.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part) for side, key in sides] for part in range(parts)
    ]
