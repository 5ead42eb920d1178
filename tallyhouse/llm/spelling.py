"""Spelling variants: words one edit apart, found by pivotal grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.merkle import lower_ascii
from tallyhouse.llm.shared import written

LEAST_LENGTH = 7  # code points of a word
LEAST_COUNT = 2
FORM_RATIO = 10  # a form is so many times as frequent as its variant
DELETED = 31  # occurrences whose digest this divides lose a code point

# Letters of a run: a to z in both cases, and the letters from À to ÿ. So there are at most
# 90 lower-cased letters, and 8,100 grams.
LETTER = "[A-Za-zÀ-ÿ]"
GRAM = 2
EDITS = 1
# The rarest grams of a word that an edit can't destroy all of, and the disjoint ones
# among them of which an edit destroys all but one.
PREFIX = GRAM * EDITS + 1
PIVOTS = EDITS + 1


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) with their occurrences.

    Runs of fewer letters than a word needs can't become one and are left out in the
    pattern. A null doc_id counts as an empty one in the digest.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(
            F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTER}{{{LEAST_LENGTH},}}"), F.lit(0))
        ).alias("raw"),
    ).select("doc", lower_ascii("raw").alias("run"))
    digest = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    return (
        runs.withColumn("h", digest)
        .select(
            F.expr(
                f"case when h % {DELETED} = 0 then concat(left(run, cast(h % length(run) as int)),"
                " substring(run, cast(h % length(run) as int) + 2)) else run end as word"
            )
        )
        .where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def gram_ranks(vocabulary: DataFrame) -> dict[str, int]:
    """Rank of each gram, the one with fewest occurrences in words first.

    There are at most 90 * 90 grams, whatever the number of words.
    """
    grams = vocabulary.select(
        F.explode(F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")).alias("gram")
    )
    counts = grams.groupBy("gram").agg(F.count("*").alias("c")).collect()
    return {row["gram"]: rank for rank, row in enumerate(sorted(counts, key=lambda r: (r["c"], r["gram"])))}


def disjoint(places: Sequence[int], costs: Sequence[int], count: int = PIVOTS) -> list[int]:
    """The ``count`` places, ascending, at least a gram apart, whose costs add up to the least.

    ``best[k][i]`` is the least cost of k of the places from the i-th on: the i-th is left
    out, or taken together with k - 1 of those that begin behind it.
    """
    size = len(places)
    none = (float("inf"), ())
    best = [[(0, ())] * (size + 1)]
    for _ in range(count):
        row = [none] * (size + 1)
        for i in range(size - 1, -1, -1):
            behind = next((j for j in range(i + 1, size) if places[j] >= places[i] + GRAM), size)
            cost, rest = best[-1][behind]
            row[i] = min(row[i + 1], (cost + costs[i], (places[i], *rest)))
        best.append(row)
    return list(best[-1][0][1])


def signature(word: str, ranks: dict[str, int]) -> tuple[list[int], list[int], list[int]]:
    """Ranks of a word's grams by place, the places of its gram prefix, and its pivots.

    The prefix holds its PREFIX rarest grams, and every further place of those grams.
    """
    of = [ranks[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    rarest = sorted(sorted(range(len(of)), key=of.__getitem__)[:PREFIX])
    bound = max(of[i] for i in rarest)
    prefix = [i for i, rank in enumerate(of) if rank <= bound]
    return of, prefix, disjoint(rarest, [of[i] for i in rarest])


def signatures(vocabulary: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """(word, n, gram, place, pivot): the gram prefix of each word, places from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows: list[int] = []
                grams: list[int] = []
                places: list[int] = []
                pivot: list[bool] = []
                for row, word in enumerate(part.column(0).to_pylist()):
                    of, prefix, chosen = signature(word, ranks)
                    rows += [row] * len(prefix)
                    grams += [of[i] for i in prefix]
                    places += prefix
                    pivot += [i in chosen for i in prefix]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(rows, pa.int64())) for c in (0, 1)),
                     pa.array(grams, pa.int32()), pa.array(places, pa.int32()), pa.array(pivot)],
                    names=["word", "n", "gram", "place", "pivot"],
                )

    schema = "word string, n long, gram int, place int, pivot boolean"
    return vocabulary.select("word", "n").mapInArrow(run, schema)


# How a pivot of one word may lie in a near word: (side that holds no edit, the near word's
# length more, the pivot's place more). Where the edit is behind it, its place is the same
# and so is all text before it; where the edit is before it, its place moves by as much
# as the length, and all text behind it is the same.
SHIFTS = [("before", d, 0) for d in (-1, 0, 1)] + [("behind", d, d) for d in (-1, 0, 1)]


def _slots(side: str, length: str, place: str, shorter: str) -> list[str]:
    """Slots of a gram in a word of the given length and place, for an edit not on ``side``.

    ``shorter`` is by how much the other side is shorter in the shorter one of both words.
    That side holds the edit, in its first half or in its last: the other half is the
    same. So a slot stands for the gram, its place, the text on ``side`` and one half.
    """
    before, behind = "left(word, place)", f"substring(word, place + {GRAM + 1})"
    same, other = (before, behind) if side == "before" else (behind, before)
    size = f"length(word) - place - {GRAM}" if side == "before" else "place"
    half = f"cast(({size} - {shorter}) div 2 as int)"
    return [
        f"xxhash64('{side} {end}', gram, {length}, {place}, {same}, {end}({other}, {half}))" for end in ("left", "right")
    ]


def near_pairs(grams: DataFrame) -> DataFrame:
    """Distinct ordered pairs (word, n, near, near_n) of words one edit apart.

    Of two such words, the pivots of the one whose gram prefix ends earlier lie in the
    prefix of the other, but for the one the edit may destroy. So each word's pivots are
    looked up in the prefixes of all words, at the places and lengths one edit allows.
    The slot of such a look-up is a hash; pairs are verified by their edit distance.
    """
    own = [x for side in ("before", "behind") for shorter in (0, 1) for x in _slots(side, "length(word)", "place", shorter)]
    held = grams.select(
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
        F.explode(F.expr(f"array_distinct(array({', '.join(own)}))")).alias("slot"),
    )
    moved = [
        x
        for side, longer, on in SHIFTS
        for x in _slots(side, f"length(word) + ({longer})", f"place + ({on})", str(max(-longer, 0)))
    ]
    asked = grams.where("pivot").select("word", "n", F.explode(F.expr(f"array({', '.join(moved)})")).alias("slot"))
    found = asked.join(held, "slot").where(f"levenshtein(word, near, {EDITS}) = {EDITS}")
    # Each pair once, whichever of its words asked and how often they met, then both ways.
    one, other = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    once = found.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    )
    there = F.struct("word", "n", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return once.distinct().select(F.explode(F.array(there, back)).alias("x")).select("x.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms of each word that has one.

    Each round a word points to where its target pointed, so reach doubles. A form is
    FORM_RATIO times as frequent as its word, so no chain is a circle, and one of the
    greatest length that counts of 64 bits allow, 18, takes five rounds.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved")
        )
        moved = written(moved, "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their near words and forms.

    Returns word, form, root, n, n_near, form_n. Words are near if one inserted, deleted
    or replaced code point makes one the other. A word's form is its near word of the
    largest n (ties: least in code-point order) if that n is at least FORM_RATIO times the
    word's; root follows the forms to the last. Null and empty texts have no words;
    repeated rows count each; other columns are not read; an empty table gives no rows.
    """
    vocabulary = written(words(docs), "words")
    pairs = near_pairs(written(signatures(vocabulary, gram_ranks(vocabulary)), "grams"))
    near = (
        pairs.groupBy("word", "n")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
        .select("word", "n_near", F.expr(f"if(-best.less >= {FORM_RATIO} * n, struct(best.near as form, -best.less as form_n), null)").alias("x"))
    )
    near = written(near.select("word", "n_near", "x.form", "x.form_n"), "near")
    ends = roots(near.where("form is not null"))
    return (
        vocabulary.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
