"""SimHash near-duplicates with pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.shared import set_aside, slices, written

SHINGLE = 4
SEED = 42
BITS = 4  # fingerprints with so many differing bits at most are linked
PIVOTS = 16
# Fingerprints that one task compares with each other; larger buckets are cut in
# tiles of this size, and each pair of tiles is a bucket of its own.
TILE = 1024
# Six blocks of bits: four differing bits leave two blocks at least untouched.
EDGES = (0, 11, 22, 33, 44, 54, 64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's shingles of ``size`` words in order; a shorter text is one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], "<u8")


def fingerprint(text: str | None) -> int:
    """Bits that are set in over half the hashes of a text's shingles."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(bits), 1 << 16):
        counts += bits[at : at + (1 << 16)].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        *keys, texts = batch.columns
        found = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*keys, pa.array(found)], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """The columns ``keys`` (longs) of each row of ``docs``, and fp of its text, a signed long."""
    own = docs.select(*(F.col(key).cast("long").alias(key) for key in keys), F.col("text").cast("string"))
    return own.mapInArrow(_fingerprints, ", ".join(f"{key} long" for key in (*keys, "fp")))


def pivot_table(fps: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Hamming distances of fingerprints (unsigned) to ``count`` reference fingerprints."""
    pivots = np.random.default_rng(SEED).integers(0, 1 << 64, count, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def linked_runs(keys: np.ndarray, fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: per row the least fingerprint (signed) that it reaches by
    links within its key, as links (a > b), at most one a row.

    Rows are compared with those 1, 2, ... places on. Pairs whose pivot distances
    differ by more than ``bits`` in any coordinate can't be linked and are discarded;
    the others are verified.
    """
    n = len(keys)
    unsigned, table = fps.view(np.uint64), pivot_table(fps.view(np.uint64))
    parent = np.arange(n)
    rows = np.arange(n)
    shift = 1
    while True:
        rows = rows[rows + shift < n]
        rows = rows[keys[rows] == keys[rows + shift]]
        if not len(rows):
            break
        near = rows
        for coordinate in range(table.shape[1]):
            column = table[:, coordinate]
            near = near[np.abs(column[near] - column[near + shift]) <= bits]
            if not len(near):
                break
        near = near[np.bitwise_count(unsigned[near] ^ unsigned[near + shift]) <= bits]
        left, right = parent[near], parent[near + shift]
        apart = left != right
        left, right = left[apart], right[apart]
        while len(left):  # join the roots, and flatten
            np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
            while True:
                flat = parent[parent]
                if np.array_equal(flat, parent):
                    break
                parent = flat
            left, right = parent[left], parent[right]
            apart = left != right
            left, right = left[apart], right[apart]
        shift += 1
    least = fps.copy()
    np.minimum.at(least, parent, fps)
    root = least[parent]
    differ = root != fps
    return fps[differ], root[differ]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of a sorted partition; the last, open bucket is carried on."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[tuple[np.ndarray, ...]] = []

    def flush(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, tile, fp = (np.concatenate(x) for x in zip(*parts))
        change = np.ones(len(key), bool)
        change[1:] = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
        a, b = linked_runs(np.cumsum(change), fp)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        last = (part[0] == part[0][-1]) & (part[1] == part[1][-1])
        cut = int(np.argmax(last))
        if cut:
            yield flush([*held, tuple(x[:cut] for x in part)])
            held = []
        held.append(tuple(x[cut:] for x in part))
    if held:
        yield flush(held)


def links(fps: DataFrame) -> DataFrame:
    """Links (a > b) that join the same fingerprints as all pairs within BITS bits.

    ``fps`` has distinct longs ``fp``. Pairs that can be linked agree in two of six
    blocks of bits, so each fingerprint goes to 15 buckets, one for each two blocks.
    A bucket of over TILE rows is cut in tiles, and each two tiles meet in a task, so
    no bucket has to fit in one; nothing is dropped.
    """
    blocks = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(EDGES, EDGES[1:])
    ]
    keys = F.array(
        *(
            F.lit(number << 32).bitwiseOR(F.shiftleft(blocks[i], 16)).bitwiseOR(blocks[j])
            for number, (i, j) in enumerate(combinations(range(6), 2))
        )
    )
    rows = fps.select("fp", F.explode(keys).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    many = rows.join(sizes, "bucket").withColumn("tiles", F.ceil(F.col("n") / TILE))
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles"))
    met = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda other: F.least(tile, other) * F.col("tiles") + F.greatest(tile, other),
    )
    tiled = many.select("bucket", F.explode(met).alias("tile"), "fp")
    sorted_ = tiled.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "fp")
    return sorted_.mapInArrow(_compare, "a long, b long")


def _rooted(own: DataFrame, least: Column) -> DataFrame:
    """(fp, least, root) for each fingerprint of ``own``: the aggregate ``least`` of its rows
    and the least fingerprint it reaches by links. One row per fingerprint, however many
    copies a text has."""
    distinct = written(own.groupBy("fp").agg(least.alias("least")), "distinct")
    roots = components(links(distinct.select("fp"))).select(F.col("node").alias("fp"), "root")
    return written(
        distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs`` (doc_id, text).

    Rows whose fingerprints differ in at most BITS bits are linked; component_id is the
    least doc_id that a row reaches. A null or empty text has fingerprint zero, linked
    like any other. Repeated rows come out as often as they went in; a null doc_id is
    returned, but never is a component's id unless all its members are null; an empty
    table gives no rows; other columns are not read.
    """
    own = written(fingerprints(docs, "doc_id"), "fingerprints")
    rooted = _rooted(own, F.min("doc_id"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any columns) that stand for their component.

    Rows are linked as in ``near_duplicates``. Of each component one row stays, the one
    with the least doc_id; a null doc_id comes behind all others, and of equal ones any
    row stays, but one alone. Null and empty texts are copies of each other. Columns come
    back as they are, whatever their names; an empty table gives no rows. The texts are
    not shuffled.
    """
    held, back = set_aside(docs, "doc_id", "text")
    rows = written(held.withColumn("row", F.monotonically_increasing_id()), "rows")
    own = written(fingerprints(rows, "row", "doc_id"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = _rooted(own, F.min(order)).groupBy("root").agg(F.min("least").alias("least"))
    return rows.join(chosen.select("least.row"), "row", "left_semi").select(*back)
