"""Connected components of a written table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import written
from tallyhouse.operators.joins import join_grouped


def _lowered(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a > b); the links of a hub can be
    split among tasks."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    star = join_grouped(both, least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    down = written(star.where("a > b").distinct(), "star")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        join_grouped(down, least, "a")
        .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
        .select("x.*")
        .where("a > b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each linked node but the roots; root is the least node it reaches.

    ``links`` has columns a > b. Stars are drawn towards the least neighbour until the
    links no longer change; the number of rounds grows with the logarithm of the size.
    Nothing but a count and a digest of the links comes to the driver.
    """
    links = written(links.select("a", "b").distinct(), "links")
    seen = None
    while True:
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if (state["n"], state["s"]) == seen or not state["n"]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (state["n"], state["s"])
        links = written(_lowered(links), "links")
