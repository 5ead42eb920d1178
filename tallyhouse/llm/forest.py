"""Nearest neighbours by a forest of hash prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import written

SEED = 7
TREES = 24
HASH_BITS = 64
# Vectors of one forest, and queries that visit it together.
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
# Share of a forest's vectors that a query gathers at least, before it stops to ascend.
SHARE = 0.55


class Forest:
    """Trees over vectors: each has the sorted hash strings (64 bits, as numbers) of all
    vectors, one bit for each random direction."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = SEED):
        self.vectors = vectors
        norms = (vectors * vectors).sum(axis=1)
        # With this coordinate all vectors have one norm, and the largest inner product
        # is at the smallest angle; a query has zero there.
        lift = np.sqrt(np.maximum(norms.max() - norms, 0.0))
        random = np.random.default_rng(seed)
        self._planes = random.normal(size=(trees, vectors.shape[1] + 1, HASH_BITS))
        hashes = self._hashes(np.column_stack([vectors, lift]))
        self._order = np.argsort(hashes, axis=1, kind="stable")
        self._sorted = np.take_along_axis(hashes, self._order, axis=1)

    def _hashes(self, lifted: np.ndarray) -> np.ndarray:
        weights = np.uint64(1) << np.arange(HASH_BITS - 1, -1, -1, dtype=np.uint64)
        return np.stack([((lifted @ plane) > 0) @ weights for plane in self._planes])

    def _ranges(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the rows that share a prefix of this length with it."""
        rest = np.uint64((1 << (HASH_BITS - length)) - 1)
        low, high = hashes & ~rest, hashes | rest
        return (
            np.stack([np.searchsorted(t, x, "left") for t, x in zip(self._sorted, low)]),
            np.stack([np.searchsorted(t, x, "right") for t, x in zip(self._sorted, high)]),
        )

    def candidates(self, queries: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """Per query at least ``least`` rows (all, if fewer), those with the longest
        common prefixes in any tree.

        Each query descends to the longest prefix that it shares with a row; from there
        all trees ascend together, a bit at a time, till there are enough rows.
        """
        rows = self.vectors.shape[0]
        hashes = self._hashes(np.column_stack([queries, np.zeros(len(queries))]))
        levels: list[tuple[np.ndarray, np.ndarray]] = [self._ranges(hashes, 0)]
        while len(levels) <= HASH_BITS:
            low, high = self._ranges(hashes, len(levels))
            if not (high > low).any():  # below the longest match of all queries
                break
            levels.append((low, high))
        for query in range(len(queries)):
            length = len(levels) - 1
            # Ranges are nested, so levels whose sizes do not even add up can be passed.
            while length and (levels[length][1][:, query] - levels[length][0][:, query]).sum() < least:
                length -= 1
            while True:
                found = np.zeros(rows, bool)
                low, high = levels[length]
                for tree, order in enumerate(self._order):
                    found[order[low[tree, query] : high[tree, query]]] = True
                hits = np.flatnonzero(found)
                if len(hits) >= least or not length:
                    break
                length -= 1
            yield hits


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of vectors that take part: no null, no non-finite, not all zero."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col("embedding").cast("array<double>")
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
        .where(~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    )


def search(embeddings: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``embeddings`` (vec_id,
    embedding) with the largest inner products found for each row of ``queries`` (same
    columns), itself left out, ties to the smaller vec_id.

    Equal vectors are one entry that keeps its k + 1 smallest ids: no other can be among
    a query's k nearest. Entries are dealt to forests of about SHARD_ROWS, and queries
    visit each in blocks. A null, zero or not finite vector takes no part, nor does a
    null vec_id; vectors of another length are not compared; repeated ids are entries
    each; an empty table gives no rows; other columns are not read.
    """
    rows = usable(embeddings)
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.withColumn("n", first).where(F.col("n") <= k + 1)
    entries = written(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    asked = written(usable(queries), "asked")
    vectors = asked.select("v").distinct()
    shards = -(-entries.count() // SHARD_ROWS)
    blocks = -(-vectors.count() // BLOCK_QUERIES)
    if not shards or not blocks:
        return entries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def dealt(frame: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        """Rows with a part of their own, and once for each part of the other side."""
        return frame.withColumns(
            {
                "size": F.size("v"),
                own: F.pmod(F.xxhash64("v"), F.lit(parts)),
                other: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))),
            }
        )

    points = dealt(entries, "shard", shards, "block", blocks)
    visits = dealt(vectors, "block", blocks, "shard", shards)
    schema = pa.schema([("v", pa.list_(pa.float64())), ("vec_id", pa.int64()), ("score", pa.float64())])

    def visit(query_rows: pa.Table, point_rows: pa.Table) -> pa.Table:
        if not query_rows.num_rows or not point_rows.num_rows:
            return schema.empty_table()
        matrix = lambda t: np.stack(t["v"].to_numpy())
        asked_, vectors_ = matrix(query_rows), matrix(point_rows)
        ids = point_rows["ids"].to_pylist()
        sizes = np.array([len(x) for x in ids])
        least = int(np.ceil(share * len(ids)))
        at, found, scores = [], [], []
        for query, hits in enumerate(Forest(vectors_).candidates(asked_, max(least, k + 1))):
            near = vectors_[hits] @ asked_[query]
            if len(near) > k + 1:  # ties at the last place stay
                edge = np.partition(near, -(k + 1))[-(k + 1)]
                hits, near = hits[near >= edge], near[near >= edge]
            own = np.concatenate([ids[h] for h in hits])
            score = np.repeat(near, sizes[hits])
            best = np.lexsort((own, -score))[: k + 1]
            at += [query] * len(best)
            found.append(own[best])
            scores.append(score[best])
        return pa.table(
            [query_rows["v"].take(pa.array(at, pa.int64())), np.concatenate(found), np.concatenate(scores)],
            schema=schema,
        )

    keys = ("size", "shard", "block")
    found = visits.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(
        visit, "v array<double>, vec_id long, score double"
    )
    order = [F.desc("score"), F.asc("vec_id")]
    merged = written(
        found.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy(*order)))
        .where(F.col("n") <= k + 1)
        .select("v", "vec_id", "score"),
        "nearest",
    )
    answers = asked.select(F.col("vec_id").alias("query_id"), "v").join(merged, "v").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("int")
    return (
        answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
