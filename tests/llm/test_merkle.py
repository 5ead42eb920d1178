"""The manifest next to a plain version of it."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import checking_sql, merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    values = (*row[:4], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_siblings(levels, at):
    found = []
    for level in levels[:-1]:
        start = at - at % 8
        found.append(("".join(level[start:at]), "".join(level[at + 1 : start + 8])))
        at //= 8
    return found


def plain_table(rows):
    groups = {}
    for row in rows:
        key = (row[0] is not None, row[0] or 0, plain_leaf(row, row[4]))
        groups.setdefault(row[2], []).append((key, row))
    languages = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {lang: sorted(groups[lang], key=lambda x: x[0]) for lang in languages}
    trees = {lang: plain_levels([key[2] for key, _ in ordered[lang]]) for lang in languages}
    top = plain_levels([trees[lang][-1][0] for lang in languages])
    table = []
    for place, lang in enumerate(languages):
        for at, (key, row) in enumerate(ordered[lang]):
            siblings = plain_siblings(trees[lang], at) + plain_siblings(top, place)
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = plain_leaf(row, text)
            for left, right in siblings:
                node = digest(left + node + right)
            proof = digest("".join(a + b for a, b in siblings))
            root = top[-1][0]
            table.append((row[0], key[2], trees[lang][-1][0], root, proof, node, node == root))
    return table


def ordered(table):
    return sorted(map(tuple, table), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


ODD = [
    (None, "s", "en", 3, "No key"), (None, None, None, None, None), (5, "s", None, 0, ""),
    (7, "s", "", 4, "Ünï Ä"), (7, "s", "", 4, "Ünï Ä"), (7, "t", "", 4, "other row, same key"),
    (9, "a:b", "zz", -1, "X" * 200_000), (-3, "s", "-", 1, "-"), (12, "s", "日本", 2, "日本"),
]


@pytest.mark.parametrize("size", [1, 8, 9, 64, 65, 512, 513, 600])
def test_manifest_is_the_plain_one(spark, size):
    rows = [(i * 3, f"src{i % 3}", "en", i, f"Text {i} A{i % 7}") for i in range(size)]
    rows += ODD if size in (9, 513) else []
    random.Random(size).shuffle(rows)
    frame = spark.createDataFrame(rows, COLUMNS).select(
        "*", *(F.lit("no").alias(c) for c in ("key", "node", "pos", "size", "leaf", "root", "tampered", "place"))
    )
    assert ordered(merkle.proof_table(frame).collect()) == ordered(plain_table(rows))


def test_many_languages_make_a_tree_of_their_own(spark):
    rows = [(i, "s", f"l{i % 530}", 1, "T") for i in range(1100)]
    assert ordered(merkle.proof_table(spark.createDataFrame(rows, COLUMNS)).collect()) == ordered(plain_table(rows))


def test_empty_table(spark):
    assert merkle.proof_table(spark.createDataFrame([], COLUMNS)).count() == 0


def test_any_changed_sibling_breaks_the_proof(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(20)]
    proofs = merkle.manifest(spark.createDataFrame(rows, COLUMNS))
    assert merkle.verified(proofs).where("not verified").isEmpty()
    other = proofs.withColumn("siblings", F.transform("siblings", lambda x: F.struct(x["right"].alias("left"), x["left"].alias("right"))))
    assert merkle.verified(other).where("verified").isEmpty()


def test_checking_sql_is_the_plain_one():
    rows = [(i * 3, f"src{i % 3}", "en", i, f"Text {i} A{i % 7}") for i in range(90)] + ODD
    with duckdb.connect() as base:
        base.sql("create table documents (doc_id bigint, source varchar, lang varchar, n_chars bigint, text varchar)")
        base.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
        assert ordered(base.sql(checking_sql.MERKLE).fetchall()) == ordered(plain_table(rows))
