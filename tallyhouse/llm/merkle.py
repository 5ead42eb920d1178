"""Merkle manifest of a dataset: a root, and for each row the proof that leads to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import written
from tallyhouse.operators.joins import join_grouped
from tallyhouse.operators.ranking import ranked

RUN = 8  # nodes that make one parent
DIGEST = 64  # hexadecimal digits of a node
LEVELS = 3  # levels of parents that a block holds
BLOCK = RUN**LEVELS  # nodes of a block's lowest level

# Fields of a leaf in the order of their hashing, and their types.
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**replaced: Column) -> Column:
    """Hash of a row's fields; ``replaced`` gives other values for some of them."""
    return F.sha2(F.concat(*(field(replaced.get(name, F.col(name))) for name in FIELDS)), 256)


def lower_ascii(column: str) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def fold(start: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(
        siblings, start, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256)
    )


def sibling_text(siblings: Column) -> Column:
    return F.array_join(F.transform(siblings, lambda level: F.concat(level["left"], level["right"])), "")


@dataclass(frozen=True)
class Tree:
    """Blocks of the trees of all keys, lowest first, and the top of each.

    ``blocks[r]`` has a row per key and aligned block: ``level0`` to ``level3`` are its
    levels, each one hexadecimal string, null above the tree's top; ``members`` is what
    its lowest nodes carry. A block's top is a node of ``blocks[r + 1]``.
    """

    blocks: list[DataFrame]
    tops: DataFrame  # key, top


def _parents(level: str, wanted: str) -> str:
    """The next level of a level string: hashes of its runs, cut out by their width."""
    width = RUN * DIGEST
    return (
        f"case when {wanted} then array_join(transform("
        f"sequence(0, cast((length({level}) - 1) div {width} as int)),"
        f" run -> sha2(substring({level}, run * {width} + 1, {width}), 256)), '') end"
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (key, pos, size, node, member) as blocks; ``size`` counts a key's nodes.

    A block is a group of at most BLOCK rows, however many rows a key has.
    """
    grouped = nodes.groupBy("key", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.max("size").alias("size"),
        F.array_sort(F.collect_list(F.struct("pos", "node", "member"))).alias("row"),
    )
    frame = grouped.select(
        "key",
        "block",
        "size",
        F.expr("array_join(transform(row, x -> x.node), '')").alias("level0"),
        F.expr("transform(row, x -> x.member)").alias("members"),
    )
    for level in range(LEVELS):
        frame = frame.withColumn(
            f"level{level + 1}", F.expr(_parents(f"level{level}", f"size > {RUN**level}"))
        )
    tops = [f"level{level}" for level in range(LEVELS, -1, -1)]
    return frame.withColumn("top", F.coalesce(*tops))


def grow(nodes: DataFrame, name: str) -> Tree:
    """Trees over nodes (key, pos, size, node, member), positions from 0 in each key."""
    blocks: list[DataFrame] = []
    while True:
        blocks.append(written(_blocks(nodes), f"{name}{len(blocks)}"))
        if (blocks[-1].agg(F.max("size")).first()[0] or 0) <= BLOCK:
            return Tree(blocks, blocks[-1].select("key", "top"))
        nodes = blocks[-1].select(
            "key",
            F.col("block").alias("pos"),
            F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"),
            F.col("top").alias("node"),
            F.lit(None).cast("int").alias("member"),
        )


def _segments(level: int) -> str:
    """What flanks the node above leaf ``at`` in its run on a level; null above the top."""
    node, width = f"shiftright(at, {3 * level})", RUN * DIGEST
    left = f"substring(level{level}, ({node} div {RUN}) * {width} + 1, ({node} % {RUN}) * {DIGEST})"
    right = f"substring(level{level}, ({node} + 1) * {DIGEST} + 1, ({RUN - 1} - {node} % {RUN}) * {DIGEST})"
    return f"if(level{level + 1} is null, null, struct({left} as left, {right} as right))"


def climb(tree: Tree, above: DataFrame) -> DataFrame:
    """(key, top, pos, node, member, siblings) of each lowest node.

    ``above`` (key, top, siblings) goes on from the top of a key's tree. Siblings are an
    array of (left, right), one entry a level. They are made once for a block, from the
    highest blocks down, and its rows share those above the block's top.
    """
    up = above.select("key", F.col("top").alias("apex"), F.lit(0).cast("long").alias("block"), "siblings")
    own = ", ".join(_segments(level) for level in range(LEVELS))
    for blocks in reversed(tree.blocks):
        rows = blocks.join(up, ["key", "block"]).withColumn(
            "at", F.explode(F.expr(f"sequence(0, cast(length(level0) div {DIGEST} as int) - 1)"))
        )
        found = rows.select(
            "key",
            "apex",
            F.expr(f"block * {BLOCK} + at").alias("pos"),
            F.expr(f"substring(level0, at * {DIGEST} + 1, {DIGEST})").alias("node"),
            F.expr("members[at]").alias("member"),
            F.expr(f"concat(filter(array({own}), x -> x is not null), siblings)").alias("siblings"),
        )
        up = found.select("key", "apex", F.col("pos").alias("block"), "siblings")
    return found.withColumnRenamed("apex", "top")


def _numbered(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Rows with their place from 0 in the order within their key, and the key's size.

    All rows are range-sorted by key and order, so a key with most rows is spread.
    """
    placed = ranked(rows, F.col(key), *order, name="place")
    sizes = placed.groupBy(key).agg(F.min("place").alias("first"), F.count("*").alias("size"))
    return join_grouped(placed, sizes, key).withColumn("pos", F.col("place") - F.col("first"))


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: its leaf, its language's subroot, the root, its siblings.

    Leaves hash the columns of FIELDS (null: ``-``). Per language they ascend by doc_id
    (null first; equal ids by leaf) and every RUN consecutive nodes make their parent
    until one is left; the subroots, ordered by language (null first, then bytewise),
    make the root in the same way. ``carried`` names expressions over the columns of
    FIELDS whose values come along; the result has doc_id, lang, leaf, subroot, root,
    siblings and those. Repeated rows are leaves each, an empty text is hashed as such,
    other columns are not read, an empty table gives no rows. Texts are hashed in the
    scan; from there on only digests move.
    """
    names = list(carried or {})
    given = docs.select(*(F.col(name).cast(kind).alias(name) for name, kind in FIELDS.items()))
    # Sorts as the languages do, null first, and is never null.
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    rows = written(
        given.select(
            key.alias("key"), leaf().alias("node"), "doc_id",
            *(value.alias(f"carried_{name}") for name, value in (carried or {}).items()),
        ),
        "leaves",
    )
    carry = [f"carried_{name}" for name in names]
    nodes = _numbered(rows, "key", F.col("doc_id").asc_nulls_first(), F.col("node")).withColumn("member", F.struct("doc_id", *carry))
    languages = grow(nodes.select("key", "pos", "size", "node", "member"), "blocks")
    subroots = _numbered(
        languages.tops.select(F.lit("").alias("all"), F.col("top").alias("node"), F.struct("key").alias("member")),
        "all",
        F.col("member"),
    )
    whole = grow(subroots.select(F.col("all").alias("key"), "pos", "size", "node", "member"), "subroots")
    root = whole.tops.first()
    nothing = whole.tops.withColumn("siblings", F.expr("cast(array() as array<struct<left:string,right:string>>)"))
    above = written(
        climb(whole, nothing).select(F.col("member.key").alias("key"), F.col("node").alias("top"), "siblings"),
        "above",
    )
    return climb(languages, above).select(
        F.col("member.doc_id").alias("doc_id"),
        F.expr("if(key = '-', null, substring(key, 2))").alias("lang"),
        F.col("node").alias("leaf"),
        F.col("top").alias("subroot"),
        F.lit(root["top"] if root else None).cast("string").alias("root"),
        "siblings",
        *(F.col(f"member.carried_{name}").alias(name) for name in names),
    )


def verified(proofs: DataFrame, leaf_column: str = "leaf") -> DataFrame:
    """``proofs`` with ``folded_root`` from the given leaf, and whether it is the root."""
    return proofs.withColumn("folded_root", fold(F.col(leaf_column), F.col("siblings"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def tampered_leaf(divisor: int = 3) -> Column:
    """The leaf of a row, with A-Z of its text lower-cased where ``divisor`` divides the
    unsigned crc32 of its decimal doc_id (never for a null one)."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0
    return F.when(chosen, leaf(text=lower_ascii("text"))).otherwise(leaf())


def proof_table(docs: DataFrame) -> DataFrame:
    """Digests of the manifest and the outcome of checking tampered rows against it."""
    proofs = verified(manifest(docs, {"tampered": tampered_leaf()}), "tampered")
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(sibling_text(F.col("siblings")), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )
