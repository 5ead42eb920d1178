"""The corpus operators on small tables with odd rows, next to plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import (
    attention_lm,
    components,
    forest,
    id_blocks,
    packing,
    page_text,
    piece_transducer,
    prefix_counts,
    robust_rules,
    simhash,
    weak_labels,
)
from tallyhouse.llm.shared import ByteBpe, tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")

LONG = "word " * 30000 + "end."
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, and then it rests a while."),
    (2, "The quick brown fox jumps over the lazy dog, and then it rests a while."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "don't <|endoftext|> y've  two   spaces\n\nlines\tñandú 日本 🙂"),
    (7, LONG),
    (None, "A row without a key has ten words of its own, surely more."),
    (8, "x"),
    (8, "x"),
]
ODD = st.lists(st.sampled_from([*"ab '\n\tré1.ing🙂▁", "ll", "the"]), max_size=24).map("".join)


def docs_of(spark, rows=TEXTS, extra=True):
    frame = spark.createDataFrame(
        [(k, t, None if k == 3 else "en", "s" if k != 4 else None) for k, t in rows],
        "doc_id long, text string, lang string, source string",
    )
    if extra:  # columns with names that the operators use themselves
        frame = frame.select("*", *(F.lit("no").alias(c) for c in ("ids", "n", "rules", "verdict", "fp", "score", "votes")))
    return frame


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark).where("false")


@pytest.fixture(scope="module")
def library():
    return ByteBpe(BPE)._library


def same_rows(found, rows=TEXTS):
    assert Counter(r["doc_id"] for r in found) == Counter(k for k, _ in rows)


# --- byte-BPE, packing, counts, blocks ---


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_ids_are_those_of_the_library(text):
    bpe = test_ids_are_those_of_the_library.__dict__.setdefault("bpe", ByteBpe(BPE))
    wanted = bpe._library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == wanted


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60), st.sampled_from([8, 64, 2048]))
def test_balance_places_each_token_once(lengths, capacity):
    pieces = packing.balance(lengths, capacity)
    by_document, by_sequence = {}, {}
    for document, start, length, sequence, offset in pieces:
        assert 0 < length <= capacity
        by_document.setdefault(document, []).append((start, length))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for found, total in ((by_document, lengths), (by_sequence, None)):
        for key, parts in found.items():
            parts.sort()
            ends = [0, *(a + n for a, n in parts)]
            assert [a for a, _ in parts] == ends[:-1]
            assert ends[-1] == total[key] if total else ends[-1] <= capacity
    # Nothing is padded: each sequence is full or a power of two.
    for parts in by_sequence.values():
        size = sum(n for _, n in parts)
        assert size == capacity or size & (size - 1) == 0


def test_pack(spark, docs, none, library):
    rows = packing.pack(docs, BPE, capacity=64, group_tokens=4096).collect()
    assert {r["doc_id"] for r in rows} == {k for k, _ in TEXTS}
    for key, text in TEXTS[:7]:
        own = sorted((r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == key)
        wanted = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert b"".join(ids for _, ids in own) == wanted
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack(none, BPE).count() == 0


@settings(max_examples=120, deadline=None)
@given(ODD | st.just("a <|endoftext|>  b<|endoftext|>"))
def test_prefix_counts_are_exact_for_each_prefix(text):
    counter = test_prefix_counts_are_exact_for_each_prefix.__dict__.setdefault(
        "c", (prefix_counts.PrefixCounts(BPE), ByteBpe(BPE)._library)
    )
    wanted = [
        len(counter[1].encode(text[: k + 1], add_special_tokens=False).ids) for k in range(len(text))
    ]
    assert counter[0].counts(text).tolist() == wanted


def test_token_counts(docs, none, library):
    rows = prefix_counts.token_counts(docs, BPE, (0, 5), table=True).collect()
    same_rows(rows)
    texts = dict(TEXTS)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        counts = [len(library.encode(text[: k + 1], add_special_tokens=False).ids) for k in range(min(len(text), 60))]
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert r["n_bytes"] == len(text.encode()) and r["chars_within_0"] == 0
        if len(text) <= 60:
            assert r["chars_within_5"] == max([k + 1 for k, n in enumerate(counts) if n <= 5], default=0)
    assert prefix_counts.token_counts(none, BPE).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=300), max_size=6), st.integers(1, 60000))
def test_blocks_round_trip(documents, factor):
    documents = [np.array(d, "<u4") * np.uint32(factor) for d in documents]
    keys = [None if i == 1 else -i for i in range(len(documents))]
    found, ids = id_blocks.read_block(id_blocks.write_block(keys, documents))
    assert found == keys and all(np.array_equal(a, b) for a, b in zip(ids, documents))


def test_blocks_find_damage():
    data = bytearray(id_blocks.write_block([1], [np.arange(500, dtype="<u4")]))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        id_blocks.read_block(bytes(data))


def test_block_coding_learns_repeated_ids():
    line = np.tile(np.arange(50, dtype="<u4") * 997, 4000)
    assert len(id_blocks.write_block([1], [line])) < len(line) // 2


def test_ids_read_back_in_order(docs, none, library):
    rows = id_blocks.placed(id_blocks.write_ids(docs, BPE)).collect()
    same_rows(rows)
    texts, at = dict(TEXTS), 0
    for r in sorted(rows, key=lambda r: r["start"]):
        ids = np.array(library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    keys = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert id_blocks.placed(id_blocks.write_ids(none, BPE)).count() == 0


# --- pieces, pages ---


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_pieces_are_those_of_the_library(text):
    import sentencepiece

    machine, library = test_pieces_are_those_of_the_library.__dict__.setdefault(
        "m", (piece_transducer.PieceTransducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES))
    )
    ids = library.encode(text)
    assert np.frombuffer(machine.encode(text), "<u4").tolist() == ids
    assert machine.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_pieces_round_trip(docs, none):
    rows = piece_transducer.decode(piece_transducer.encode(docs, PIECES), PIECES).collect()
    same_rows(rows)
    texts = dict(TEXTS)
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in rows)
    assert piece_transducer.encode(none, PIECES).count() == 0


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
        ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
        ("<table><tr><th>a<th>bb<tr><td>long<td>x</table>", "a     bb\nlong  x"),
        ("a<script>var t='</p>';</script><style>x</style><span hidden>no</span>b", "ab"),
        ("<div style='color:red;display: none'>no<p>no</div>yes", "yes"),
        ("<pre> k\n  l</pre>", " k\n  l"),
        ("x &lt; y &amp;  z", "x < y & z"),
        ("<title>t</title><b>un<i>closed", "unclosed"),
        ("</p></td>stray<!-- no -->", "stray"),
        ("<div>" * 5000 + "deep", "deep"),
    ],
)
def test_render(source, text):
    assert page_text.render(source) == text


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None)], "page_id long, url string, html string")
    assert sorted(map(tuple, page_text.page_texts(pages).collect()), key=str) == [(1, "a"), (1, "a"), (None, "")]
    assert page_text.page_texts(pages.where("false")).count() == 0


# --- SimHash ---


def plain_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for _, text in TEXTS:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(fps, ids):
    least = dict(enumerate(range(len(fps))))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if bin(fps[i] ^ fps[j]).count("1") <= 4 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return [min(ids[j] for j in least if least[j] == least[i]) for i in least]


def test_links_lose_none(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)  # tiles of large buckets
    random = np.random.default_rng(5)
    fps = [0, 0xF, 0xFF, 1 << 63]
    for base in random.integers(0, 1 << 64, 6, dtype=np.uint64):
        for _ in range(25):
            flips = random.choice(64, random.integers(0, 7), replace=False)
            fps.append(int(base) ^ sum(1 << int(b) for b in flips))
    fps = list(dict.fromkeys(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = components.components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")))
    root = {r["node"]: r["root"] for r in found.collect()}
    wanted = plain_components(fps, signed)
    assert [root.get(f, f) for f in signed] == wanted


def test_near_duplicates(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    same_rows(rows)
    own = {r["doc_id"]: r["component_id"] for r in rows}
    assert own[1] == own[2] == 1 and own[3] == own[4] == own[5] == 3 and own[8] == 8 and own[None] is None
    kept = simhash.representatives(docs).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter([1, 3, 6, 7, None, 8])
    assert simhash.near_duplicates(none).count() == simhash.representatives(none).count() == 0


def planted_copies(random, bases=14):
    """Texts, and copies of them with some words replaced."""
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for size in random.integers(60, 300, bases):
        base = list(random.choice(words, size))
        texts.append(base)
        for changes in (0, 0, 1, 2, 3, 6):
            copy = list(base)
            for at in random.choice(size, changes, replace=False):
                copy[at] = f"new{random.integers(1 << 30)}"
            texts.append(copy)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("tile", [1024, 3])
def test_stage_keeps_one_document_of_each_component(spark, monkeypatch, tile):
    import corpus_pipeline

    monkeypatch.setattr(simhash, "TILE", tile)  # tiles of large buckets
    random = np.random.default_rng(7)
    texts = [*planted_copies(random), "", None, " \n"]
    ids = random.permutation(len(texts)).tolist()
    wanted = sorted(set(plain_components([plain_fingerprint(t) for t in texts], ids)))
    assert 14 < len(wanted) < len(texts) - 28
    kept = corpus_pipeline.near_duplicates(spark, docs_of(spark, list(zip(ids, texts))), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == wanted


def test_stage_with_rows_without_or_with_equal_keys(spark):
    rows = [(None, "one text of five words"), (None, "one text of five words"), (4, None), (4, ""), (None, "")]
    kept = simhash.representatives(docs_of(spark, rows)).collect()
    assert Counter((r["doc_id"], (r["text"] or "")[:3]) for r in kept) == Counter([(None, "one"), (4, "")])


# --- rules, classifier, language model ---


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


RULE_TEXTS = [
    *TEXTS,
    (20, "a b c d e f a b c d e g\na b\na b\n\n \n# $ | <x>"),
    (21, "one two three four five six seven eight nine ten " * 3),
]


def test_rules(spark, none):
    rows = robust_rules.quality_rules(docs_of(spark, RULE_TEXTS)).collect()
    same_rows(rows, RULE_TEXTS)
    for r in rows:
        found = tuple(r[c] for c in robust_rules.STATISTICS)
        assert found == plain_statistics(dict(RULE_TEXTS)[r["doc_id"]])
        assert r["base_failed"] == (found[0] < 10 or 100 * found[4] > 20 * found[0])
        assert not (r["kept"] and r["base_failed"])
    assert robust_rules.quality_rules(none).count() == 0
    assert robust_rules.kept_documents(none).count() == 0


def test_rules_reject_outliers_only(spark):
    random = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "singular", "tree", "house"]
    rows = [(i, " ".join(random.choice(words, random.integers(80, 200)))) for i in range(400)]
    rows += [(1000 + i, " ".join(w + "###$$$" for w in random.choice(words, 120))) for i in range(30)]
    frame = docs_of(spark, rows)
    found = {r["doc_id"]: r["kept"] for r in robust_rules.quality_rules(frame).collect()}
    assert all(found[i] for i in range(400)) and not any(found[1000 + i] for i in range(30))
    kept = robust_rules.kept_documents(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == set(range(400))


def plain_vector(text):
    words, chars, symbols, dup, repeats = plain_statistics(text)
    lines = max(len([x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]), 1)
    n, c = max(words, 1), max(chars, 1)
    return [math.log(n), math.log(c / n), math.log1p(100 * symbols / c), math.log1p(dup) * dup / lines, math.sqrt(repeats / n)]


def plain_distances(groups):
    """Squared distances of the rows of each (language, source) of vectors, in loops of numpy."""
    rules, d = robust_rules, robust_rules.DIMENSIONS

    def edge(values, share, width):
        value = np.sort(values)[math.ceil(share * len(values)) - 1]
        return (math.floor(value / width) + 1) * width

    def leaning(parts, weigh):
        """Sums and rows by group to means that lean on the language and on all."""
        k, prior = {}, rules.PRIOR_ROWS
        whole = sum(p for p, _ in parts.values()) / sum(n for _, n in parts.values()) if weigh is None else weigh["all"]
        for lang in {lang for lang, _ in parts}:
            own = [parts[g] for g in parts if g[0] == lang]
            total, n = (sum(p for p, _ in own), sum(n for _, n in own)) if weigh is None else weigh[lang]
            behind = (total + prior * whole) / (n + prior)
            k |= {g: (p + prior * behind) / (n + prior) for g, (p, n) in parts.items() if g[0] == lang}
        return k

    def factor(mean):
        m, p = mean[0], mean[1:]
        cov, low = p - np.outer(m, m), np.zeros((d, d))
        for j in range(d):
            for i in range(j, d):
                value = cov[i, j] - low[i, :j] @ low[j, :j]
                low[i, j] = math.sqrt(max(value, 0) + rules.FLOORS[j] ** 2) if i == j else value / low[j, j]
        return m, low

    def squared(x, model):
        return np.square(np.linalg.solve(model[1], (x - model[0]).T)).sum(axis=0)

    starts = []
    for start in (0, 1):
        near = {}
        for g, x in groups.items():
            middle = np.array([edge(v, 0.5, 0.01) for v in x.T])
            off = np.array([edge(v, 0.5, 0.01) for v in abs(x - middle).T])
            z2 = np.square((x - middle) / np.maximum(off * 1.4826, rules.FLOORS))
            near[g] = z2.max(axis=1) if start else z2.sum(axis=1)
        for step in range(rules.STEPS):
            if step:
                near = {g: squared(x, models[g]) for g, x in groups.items()}
            parts = {}
            for g, x in groups.items():
                rank = np.log(near[g] + 1e-6)
                core = x[rank < edge(rank, rules.CORE, 0.02)]
                parts[g] = np.vstack([core.sum(axis=0), core.T @ core]), len(core)
            models = {g: factor(mean) for g, mean in leaning(parts, None).items()}
        starts.append(models)
    spread = lambda model: np.log(np.diag(model[1])).sum()
    best = {g: min((s[g] for s in starts), key=spread) for g in groups}
    found = {g: squared(x, best[g]) for g, x in groups.items()}
    ranks = {g: np.log(f + 1e-6) for g, f in found.items()}
    medians = {g: (edge(r, 0.5, 0.02) * len(r), len(r)) for g, r in ranks.items()}
    levels = {"all": edge(np.concatenate(list(ranks.values())), 0.5, 0.02)}
    for lang in {lang for lang, _ in groups}:
        own = np.concatenate([r for g, r in ranks.items() if g[0] == lang])
        levels[lang] = edge(own, 0.5, 0.02) * len(own), len(own)
    scale = {g: max(math.exp(e) / rules.CHI_MEDIAN, 1) for g, e in leaning(medians, levels).items()}
    return {g: f / scale[g] for g, f in found.items()}


def test_rules_are_those_of_a_plain_estimate(spark):
    """Groups of one to 300 rows, null languages and sources, planted outliers."""
    random = np.random.default_rng(12)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "singular", "tree", "house", "so#me", "lin&e\n"]
    rows = []
    for lang, source, n in [("en", "a", 300), ("en", "b", 40), ("en", None, 1), ("de", "a", 90), (None, "c", 7), (None, None, 2)]:
        for i in range(n):
            mark = "$$$" if i % 17 == 3 else ""
            text = " ".join(w + mark for w in random.choice(words, random.integers(60, 200)))
            rows.append((len(rows), text, lang, source))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    passed = {}
    for key, text, lang, source in rows:
        s = plain_statistics(text)
        if s[0] >= 10 and 100 * s[4] <= 20 * s[0]:
            passed.setdefault((lang, source), []).append((key, plain_vector(text)))
    wanted = plain_distances({g: np.array([v for _, v in own]) for g, own in passed.items()})
    wanted = {key: float(d) for g, own in passed.items() for (key, _), d in zip(own, wanted[g])}
    found = {r["doc_id"]: r for r in robust_rules.quality_rules(frame).collect()}
    assert len(found) == len(rows) and len(wanted) > 400
    for key, distance in wanted.items():
        assert math.isclose(found[key]["distance"], distance, rel_tol=1e-6, abs_tol=1e-9)
        assert found[key]["kept"] == (distance <= robust_rules.CUTOFF)
    assert not all(found[key]["kept"] for key in wanted)
    kept = {r["doc_id"] for r in robust_rules.kept_documents(frame).collect()}
    assert kept == {key for key, distance in wanted.items() if distance <= robust_rules.CUTOFF}


def test_label_model_trusts_the_accurate():
    random = np.random.default_rng(1)
    truth = random.random(4000) < 0.7
    accuracy = [0.95, 0.9, 0.85, 0.6, 0.55]
    cast = np.stack([np.where(random.random(4000) < a, truth, ~truth).astype(int) for a in accuracy], axis=1)
    cast[random.random(cast.shape) < 0.2] = weak_labels.ABSTAIN
    posterior, table = weak_labels.label_model(Counter("".join(map(str, row)) for row in cast))
    found = np.array([posterior["".join(map(str, row))] > 0.5 for row in cast])
    assert (found == truth).mean() > 0.93
    assert table[0, 1, 1] > 0.9 > table[4, 1, 1]


def test_classifier(spark, docs, none):
    rows = weak_labels.classify(docs).collect()
    same_rows(rows)
    assert weak_labels.classify(none).count() == weak_labels.kept_documents(none).count() == 0
    random = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "singular", "tree", "house"]
    made = [(i, " ".join(random.choice(words, 60)).capitalize() + ".") for i in range(150)]
    made += [(1000 + i, " ".join(w.upper() + "!!" for w in random.choice(words, 60))) for i in range(50)]
    frame = docs_of(spark, made)
    found = {r["doc_id"]: r["kept"] for r in weak_labels.classify(frame).collect()}
    assert all(found[i] for i in range(150)) and not any(found[1000 + i] for i in range(50))
    assert weak_labels.kept_documents(frame).columns == frame.columns


def test_slopes_are_right():
    random = np.random.default_rng(2)
    model = attention_lm.start_model(random.integers(0, 9, attention_lm.SYMBOLS).astype(float))
    model = {k: v.astype(np.float64) for k, v in model.items()}
    ids = random.integers(0, attention_lm.SYMBOLS, (3, attention_lm.WINDOW + 1))
    scored = np.arange(attention_lm.WINDOW) < np.array([32, 7, 20])[:, None]
    loss = lambda: -attention_lm.log_probabilities(model, ids[:, :-1], ids[:, 1:], scored).mean()
    found = attention_lm.slopes(model, ids[:, :-1], ids[:, 1:], scored)
    for name, value in model.items():
        at = np.unravel_index(np.abs(found[name]).argmax(), value.shape)
        kept, step = value[at], 1e-4
        value[at] = kept + step
        up = loss()
        value[at] = kept - step
        down = loss()
        value[at] = kept
        assert math.isclose((up - down) / (2 * step), found[name][at], rel_tol=2e-2, abs_tol=1e-6), name


def test_model_is_causal_and_sums_to_one():
    model = attention_lm.start_model(np.ones(attention_lm.SYMBOLS), seed=3)
    ids = np.random.default_rng(0).integers(0, attention_lm.SYMBOLS, (1, attention_lm.WINDOW))
    other = ids.copy()
    other[0, 20:] = 5
    a, b = (attention_lm._hidden(model, x)["h"] for x in (ids, other))
    assert np.allclose(a[:20], b[:20]) and not np.allclose(a[20:], b[20:])
    inputs = np.repeat(ids, attention_lm.SYMBOLS, axis=0)
    targets = np.zeros_like(inputs)
    targets[:, 3] = np.arange(attention_lm.SYMBOLS)
    only = np.zeros(inputs.shape, bool)
    only[:, 3] = True
    assert math.isclose(np.exp(attention_lm.log_probabilities(model, inputs, targets, only)).sum(), 1, rel_tol=1e-3)


@pytest.mark.parametrize("size", [1, 2, 31, 32, 33, 56, 57, 100])
def test_windows_score_each_symbol_once(size):
    texts = [np.arange(1, size + 1, dtype=np.uint16), np.array([7], np.uint16)]
    windows, first, last, owner = attention_lm.windows_of(texts)
    scored = [windows[i, 1 + first[i] : 1 + last[i]].tolist() for i in range(len(owner)) if owner[i] == 0]
    assert [x for part in scored for x in part] == texts[0].tolist()
    assert windows[-1, 1] == 7 and windows[-1, 0] == 0


def test_scores(docs, none):
    rows = attention_lm.score(docs, BPE).collect()
    same_rows(rows)
    texts = dict(TEXTS)
    counts = Counter()
    for key, text in TEXTS:
        if key is not None and zlib.crc32(str(key).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            counts[b""] += 1
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        tokens = (texts[r["doc_id"]] or "").encode().lower().split() + [b""]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    assert attention_lm.score(none, BPE).count() == 0


def test_weights_learn_from_all_training_documents(spark):
    random = np.random.default_rng(4)
    words = ["river", "stone", "garden", "window", "market", "silver", "yellow", "winter"]
    frame = spark.range(240).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(32)) == 0).alias("mixed"))
    rows = [
        (r["doc_id"], " ".join(random.choice(words, 80) if r["mixed"] else words * 10)) for r in frame.collect()
    ]  # one document in 32 has the words in random order, the others have them in turn
    mixed = {r["doc_id"] for r in frame.where("mixed").collect()}
    found = attention_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), BPE).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] not in mixed]
    assert len(mixed) > 2 and len(held) > 10
    assert sum(r["score"] for r in held) > 0.3 * sum(r["base_score"] for r in held)


# --- nearest neighbours ---


def test_search_is_exact_on_a_whole_forest(spark):
    random = np.random.default_rng(1)
    vectors = [random.normal(size=8).tolist() for _ in range(60)] + [[1.0] * 8] * 40
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    odd = [(200, None, 0), (220, [0.0] * 8, 0), (240, [math.nan] * 8, 0), (260, [None] * 8, 0), (280, [math.inf] * 8, 0), (300, [2.0] * 3, 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")
    found = forest.search(frame, frame.where("vec_id % 20 = 0"), k=5, share=1.0).collect()
    for query in (0, 20, 40, 60, 80):
        scores = sorted((-float(np.dot(vectors[query], v)), i) for i, v in enumerate(vectors) if i != query)
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        assert [i for _, i, _ in own] == [i for _, i in scores[:5]]
        assert np.allclose([s for *_, s in own], [-s for s, _ in scores[:5]])
    assert {r["query_id"] for r in found} == {0, 20, 40, 60, 80}
    assert forest.search(frame.where("false"), frame.where("false")).count() == 0


def test_forest_recall(spark):
    random = np.random.default_rng(8)
    vectors = random.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    queries = vectors[::100]
    hits = 0
    for query, found in zip(queries, forest.Forest(vectors).candidates(queries, int(forest.SHARE * 4000))):
        hits += len(set(np.argsort(-(vectors @ query))[:20]) & set(found.tolist()))
    assert hits / (20 * len(queries)) >= 0.9


# --- whole stages, clashing names, exact search for room ---


def plain_balance(lengths, capacity):
    """Every sequence is looked at for every piece."""
    sizes = packing.sequence_sizes(sum(lengths), capacity)
    pieces, rest, full = [], [], 0
    for document, length in enumerate(lengths):
        for start in range(0, length - length % capacity, capacity):
            pieces.append((document, start, capacity, full, 0))
            full += 1
        if length % capacity:
            rest.append((length % capacity, document, length - length % capacity))
    rest.sort(key=lambda x: (-packing.attention_cost(x[0]), x[1]))
    left = {q: size for q, size in enumerate(sizes) if q >= full}
    cost = dict.fromkeys(left, 0.0)
    for length, document, start in rest:
        while length:
            fits = [q for q in left if left[q] >= length] or [q for q in left if left[q]]
            chosen = min(fits, key=lambda q: (cost[q], q))
            taken = min(length, left[chosen])
            pieces.append((document, start, taken, chosen, sizes[chosen] - left[chosen]))
            left[chosen] -= taken
            cost[chosen] += packing.attention_cost(taken)
            start, length = start + taken, length - taken
    return pieces


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.sampled_from([1, 7, 16, 32]))
def test_documents_are_cut_only_where_none_has_room(lengths, capacity):
    assert packing.balance(lengths, capacity) == plain_balance(lengths, capacity)


def test_room_is_found_among_many_sequences():
    random = np.random.default_rng(11)
    lengths = [int(x) for x in np.minimum(random.lognormal(5.5, 1.1, 3000), 9000) + 1]
    assert packing.balance(lengths) == plain_balance(lengths, packing.CAPACITY)


def test_stages_keep_clashing_columns(spark):
    """Columns with names that the stages use keep value and type through both of them."""
    random = np.random.default_rng(8)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "singular", "tree", "house"]
    rows = [(i, " ".join(random.choice(words, 90))) for i in range(60)]
    names = ["rules", "verdict", "__words", "__text", "row", "__row", "key", "lang_key", "x0", "group", "odd`name", "a.b"]
    frame = docs_of(spark, rows, extra=False).select(
        "*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names)
    )
    for stage in (robust_rules.kept_documents, simhash.representatives):
        kept = stage(frame)
        assert kept.dtypes == frame.dtypes
        wanted = {r[0]: tuple(r) for r in frame.collect()}
        found = kept.collect()
        assert found and all(tuple(r) == wanted[r[0]] for r in found)


# --- classifier, language model and the pipeline next to plain versions ---


def plain_posteriors(cast):
    """Posterior of "good" of each row of votes, class by class and vote by vote."""
    share = [(v.count("1") + 1) / (v.count("1") + v.count("0") + 2) for v in cast]
    for _ in range(weak_labels.EM_STEPS):
        classes = [[1 - p for p in share], share]
        prior = [(sum(c) + 1) / (len(cast) + 2) for c in classes]
        table = {}
        for labeller in range(len(cast[0])):
            for c, mass in enumerate(classes):
                n = [1 + sum(m for m, v in zip(mass, cast) if v[labeller] == x) for x in "01"]
                table |= {(labeller, c, x): n[int(x)] / sum(n) for x in "01"}
        odds = [
            [math.log(prior[c]) + sum(math.log(table[i, c, x]) for i, x in enumerate(v) if x != "2") for c in (0, 1)]
            for v in cast
        ]
        share = [1 / (1 + math.exp(min(max(bad - good, -50), 50))) for bad, good in odds]
    return share


def plain_classifier(texts):
    """Posteriors, and scores of a logistic scorer over a dense table of features."""
    posterior = np.array(plain_posteriors([weak_labels.votes(t) for t in texts]))
    table = np.zeros((len(texts), weak_labels.DIMENSIONS + 1))
    table[:, -1] = 1
    for row, text in zip(table, texts):
        for slot, n in Counter(s for w in (text or "").split() for s in weak_labels._word_features(w)).items():
            row[slot] = math.log1p(n)
        row[:-1] /= max(math.sqrt(row[:-1] @ row[:-1]), 1e-9)
    good = posterior > 0.5
    prior = min(max(good.mean(), 0.02), 0.98)
    weight = np.where(good, prior / max(good.mean(), 1e-6), (1 - prior) / max(1 - good.mean(), 1e-6))
    model, speed = np.zeros(table.shape[1]), 0
    decay = np.append(np.full(weak_labels.DIMENSIONS, 1e-5), 0)
    for _ in range(300):
        error = weight * (1 / (1 + np.exp(-(table @ model))) - posterior) / len(texts)
        speed = 0.9 * speed - 4.0 * (error @ table + decay * model)
        model = model + speed
    return posterior, 1 / (1 + np.exp(-(table @ model)))


def mixed_documents(random, n=110):
    """Clean texts, shouted ones, symbols, repeats, copies, and odd rows."""
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "singular", "tree", "house", "river", "stone"]
    texts = []
    for i in range(n):
        picked = list(random.choice(words, random.integers(50, 140)))
        if i % 6 == 1:
            picked = [w.upper() + "!!" for w in picked]
        if i % 13 == 5:
            picked = [w + "##$$" for w in picked]
        picked[0] = picked[0][0].upper() + picked[0][1:]
        texts.append(" ".join(picked) + ".")
        if i % 9 == 0:
            texts.append(texts[-1].replace("river", "River"))
    return [*texts, "too short", "one two three four five six seven " * 9, "", None]


def test_classifier_is_that_of_a_dense_table(spark):
    texts = mixed_documents(np.random.default_rng(21))
    posterior, score = plain_classifier(texts)
    found = {r["doc_id"]: r for r in weak_labels.classify(docs_of(spark, list(enumerate(texts)))).collect()}
    assert len(found) == len(texts)
    for i in range(len(texts)):
        assert math.isclose(found[i]["posterior"], posterior[i], rel_tol=1e-6, abs_tol=1e-9)
        assert math.isclose(found[i]["score"], score[i], rel_tol=1e-5)
        assert found[i]["kept"] == (score[i] >= weak_labels.KEEP_FROM)
    assert 20 < sum(r["kept"] for r in found.values()) < len(texts)


def plain_text_score(model, symbols):
    """log10 probability of a text's symbols, each from its own context, one at a time."""
    step, line, total = attention_lm.WINDOW - attention_lm.OVERLAP, [0, *symbols], 0.0
    log_softmax = lambda z, i: z[i] - z.max() - math.log(np.exp(z - z.max()).sum())
    for at, symbol in enumerate(symbols):
        window = 0 if at < attention_lm.WINDOW else 1 + (at - attention_lm.WINDOW) // step
        seen = line[window * step : at + 1]
        x = model["embed"][seen] + model["place"][: len(seen)]
        scores = (x @ model["key"]) @ (x[-1] @ model["query"]) / math.sqrt(attention_lm.HEAD)
        weights = np.exp(scores - scores.max())
        h = x[-1] + (weights / weights.sum()) @ (x @ model["value"]) @ model["out"]
        group, member = divmod(symbol, attention_lm.MEMBERS)
        total += log_softmax(h @ model["class"] + model["class_bias"], group)
        total += log_softmax(h @ model["member"][group] + model["member_bias"][group], member)
    return total / math.log(10)


def test_scores_are_those_of_one_symbol_at_a_time(spark):
    texts = [t for t in mixed_documents(np.random.default_rng(5), 24)]
    frame = docs_of(spark, list(enumerate(texts)), extra=False).select("doc_id", "text").cache()
    model, chosen, _ = attention_lm.train(frame, BPE)
    model = {name: value.astype(np.float64) for name, value in model.items()}
    symbols = attention_lm.Symbols(BPE, chosen)
    for r in attention_lm.score(frame, BPE).collect():
        own = symbols.of([attention_lm.words_of(texts[r["doc_id"]])])[0].tolist()
        assert math.isclose(r["score"], plain_text_score(model, own), rel_tol=2e-3)


def test_pipeline_is_its_plain_stages_in_turn(spark, tmp_path, library):
    import corpus_pipeline

    texts = mixed_documents(np.random.default_rng(33), 150)
    rows = [(i, t, None if i % 50 == 7 else "en", f"s{i % 3}") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))

    groups = {}
    for key, text, lang, source in rows:
        s = plain_statistics(text)
        if s[0] >= 10 and 100 * s[4] <= 20 * s[0]:
            groups.setdefault((lang, source), []).append(key)
    distances = plain_distances({g: np.array([plain_vector(texts[k]) for k in keys]) for g, keys in groups.items()})
    sound = sorted(k for g, keys in groups.items() for k, d in zip(keys, distances[g]) if d <= robust_rules.CUTOFF)
    scores = plain_classifier([texts[k] for k in sound])[1]
    good = [k for k, score in zip(sound, scores) if score >= weak_labels.KEEP_FROM]
    wanted = set(plain_components([plain_fingerprint(texts[k]) for k in good], good))
    assert len(texts) > len(sound) > len(good) > len(wanted) > 60  # each stage takes some

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == wanted
    sequences = {}
    for key in wanted:
        ids = np.array(library.encode(texts[key], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted((r for r in found if r["doc_id"] == key), key=lambda r: r["start"]):
            piece = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= packing.CAPACITY
