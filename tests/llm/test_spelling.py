"""Spelling variants next to a plain version that compares all words."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import checking_sql, spelling


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for raw in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_variants(rows):
    counts = plain_words(rows)
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best and counts[best] >= 10 * counts[word] else None
    table = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        table.add((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return table


def variants(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.select("*", *(F.lit("no").alias(c) for c in ("word", "n", "near", "slot", "gram", "root", "form")))
    found = [tuple(r) for r in spelling.variants(frame).collect()]
    assert len(found) == len(set(found))
    return set(found)


def changed(random_, word):
    at, letter = random_.randrange(len(word)), random_.choice("abcdéÿ")
    return random_.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def test_variants_are_those_of_all_pairs(spark):
    random_ = random.Random(4)
    base = ["".join(random_.choice("abcdeé") for _ in range(random_.randint(7, 11))) for _ in range(30)]
    rows = []
    for i in range(400):
        chosen = [random_.choice(base) for _ in range(12)]
        rows.append((i, " ".join(w if random_.random() < 0.8 else changed(random_, w) for w in chosen)))
    # Words of one repeated letter, chains of forms, upper case, other letters in between.
    rows += [(1000 + k, " ".join(["a" * k] * 3)) for k in range(7, 14)]
    chain = [("chainword", 900), ("chainwore", 60), ("chainwoxe", 3)]
    rows += [(2000 + i, f"{word.upper()}, {word}") for word, n in chain for i in range(n // 2 + 1)]
    rows += [(None, "keyless keyless keylesss Keyless"), (3, None), (4, ""), (5, "short wörds ÀÖ×÷øÿàß ÀÖ×÷øÿàß")]
    rows += [(6, "repeated repeated"), (6, "repeated repeated"), (7, "verylong" * 3000 + " " + "verylong" * 3000)]
    wanted = plain_variants(rows)
    assert sum(form is not None for _, form, *_ in wanted) > 30
    assert any(form and form != root for _, form, root, *_ in wanted)
    assert variants(spark, rows) == wanted
    with duckdb.connect() as base:
        base.sql("create table documents (doc_id bigint, text varchar)")
        base.executemany("insert into documents values (?, ?)", rows)
        assert set(base.sql(checking_sql.SPELLING).fetchall()) == wanted


def test_no_words(spark):
    assert variants(spark, []) == set()
    assert variants(spark, [(1, "a few short ones"), (2, None)]) == set()


def test_a_hub_of_near_words(spark):
    # One very frequent word, and many words one edit from it.
    base = "frequently"
    near = sorted({base[:i] + c + base[i + 1 :] for i in range(len(base)) for c in "abcxyzéèêë"} - {base})
    rows = [(i, " ".join([base] * 60)) for i in range(20)] + [(100 + i, f"{w} {w}") for i, w in enumerate(near)]
    assert variants(spark, rows) == plain_variants(rows)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=7, max_size=12), st.data())
def test_pivots_find_every_near_word(word, data):
    """Of two words one edit apart, a pivot of one lies in the gram prefix of the other, its
    place as the edit allows, whatever the order of the grams."""
    at, letter = data.draw(st.integers(0, len(word) - 1)), data.draw(st.sampled_from("abc"))
    other = data.draw(st.sampled_from([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]]))
    grams = sorted({w[i : i + 2] for w in (word, other) for i in range(len(w) - 1)})
    ranks = dict(zip(data.draw(st.permutations(grams)), range(len(grams))))
    held = {w: {(of[i], i) for i in prefix} for w in (word, other) for of, prefix, _ in [spelling.signature(w, ranks)]}
    met = False
    for a, b in ((word, other), (other, word)):
        of, _, pivots = spelling.signature(a, ranks)
        assert len(pivots) == 2 and pivots[1] >= pivots[0] + 2
        for p in pivots:
            same = (of[p], p) in held[b] and a[:p] == b[:p]
            moved = p + len(b) - len(a)
            met |= same or ((of[p], moved) in held[b] and a[p + 2 :] == b[moved + 2 :])
    assert met


def test_disjoint_is_the_least_of_all_choices():
    random_ = random.Random(3)
    for _ in range(200):
        places = sorted(random_.sample(range(14), 6))
        costs = [random_.randrange(50) for _ in places]
        cost = dict(zip(places, costs))
        choices = [c for c in itertools.combinations(places, 2) if c[1] >= c[0] + 2]
        found = spelling.disjoint(places, costs)
        assert sum(cost[p] for p in found) == min(sum(cost[p] for p in c) for c in choices)
