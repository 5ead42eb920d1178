"""The test tables before some of their rows came, moved or changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.medallion import Tables

# Orders that come late (their lines and payments are there before), orders
# whose day moves by more than a month, and refunds that come late.
LATE = "id % 97 = 0 and placed_at >= '1997-06-01'"
MOVED = "id % 89 = 0 and placed_at >= '1997-06-01'"
REFUNDED = "substring(id, -1, 1) = '7' and created_at >= '1997-09-01'"
LATER = 20  # years, after every instant of the test files


class Before:
    """The source at first."""

    def __init__(self, source: Tables):
        self.source = source

    def table(self, name: str) -> DataFrame:
        frame = self.source.table(name)
        if name == "orders":
            moved = F.expr(f"if({MOVED}, timestampadd(DAY, -40, placed_at), placed_at)")
            return frame.where(f"not ({LATE})").withColumn("placed_at", moved)
        return frame.where(f"not ({REFUNDED})") if name == "refunds" else frame


class After:
    """The source later: changed rows carry an instant after all others."""

    def __init__(self, source: Tables):
        self.source = source

    def table(self, name: str) -> DataFrame:
        frame = self.source.table(name)
        if name == "orders":
            later = f"if(({LATE}) or ({MOVED}), timestampadd(YEAR, {LATER}, updated_at), updated_at)"
            return frame.withColumn("updated_at", F.expr(later))
        if name == "refunds":
            later = f"if({REFUNDED}, timestampadd(YEAR, {LATER}, created_at), created_at)"
            return frame.withColumn("created_at", F.expr(later))
        return frame
