"""Quality classifier: a label model over heuristic labellers trains a linear scorer."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import slices, written

GOOD, BAD, ABSTAIN = 1, 0, 2
DIMENSIONS = 1 << 14
# Rows of each class that the linear scorer is trained on: those with the least hashes.
TRAIN_ROWS = 2000
EM_STEPS = 60
# Only what the scorer holds to be bad with 0.7 or more is rejected.
KEEP_FROM = 0.3
_SYMBOL = re.compile(r"[#*$%&|<>=_~^\\]")


def _between(value: float, good: float, bad: float) -> int:
    """Good up to one limit, bad from another, else no vote."""
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def votes(text: str | None) -> str:
    """One letter per labeller: 1 good, 0 bad, 2 abstains."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = len(words)
    if not n:
        return "0" * len(LABELLERS)
    characters = sum(map(len, words))
    ends = sum(line.rstrip().endswith((".", "!", "?", '"', "”", ":")) for line in lines)
    upper = sum(w.isupper() and len(w) > 2 for w in words)
    twins = [tuple(words[i : i + 3]) for i in range(0, n - 2)]
    facts = {
        "symbols": _between(len(_SYMBOL.findall(text)) / characters, 0.02, 0.1),
        "capitals": _between(upper / n, 0.1, 0.4),
        "word_length": GOOD if 2.5 <= characters / n <= 11 else BAD,
        "length": BAD if n < 10 else GOOD if n >= 40 else ABSTAIN,
        "lines": _between(1 - len(set(lines)) / len(lines), 0.05, 0.3),
        "repeats": _between(1 - len(set(twins)) / len(twins), 0.05, 0.3) if n >= 20 else ABSTAIN,
        "sentences": GOOD if ends >= 0.6 * len(lines) else BAD if ends <= 0.1 * len(lines) else ABSTAIN,
        "marks": _between(sum(not any(c.isalnum() for c in w) for w in words) / n, 0.02, 0.15),
        "shouts": _between(sum(w.endswith(("!!", "??")) for w in words) / n, 0.02, 0.2),
        "commonest": _between(Counter(words).most_common(1)[0][1] / n, 0.12, 0.3) if n >= 20 else ABSTAIN,
    }
    return "".join(str(facts[name]) for name in LABELLERS)


LABELLERS = (
    "symbols", "capitals", "word_length", "length", "lines", "repeats", "sentences", "marks", "shouts", "commonest",
)


def label_model(counts: dict[str, int], steps: int = EM_STEPS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of "good" for each pattern of votes, and each labeller's table of
    probabilities (labeller, class, vote), by expectation and maximisation.

    Patterns come with the number of rows that have them; there are 3^10 at most.
    The first posterior is the share of good votes. A labeller that abstains says
    nothing: its table counts the votes it gave.
    """
    patterns = sorted(counts)
    cast = np.array([[int(c) for c in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], float)
    one_hot = (cast[:, :, None] == np.arange(2)).astype(float)
    good, bad = (cast == GOOD).sum(axis=1), (cast == BAD).sum(axis=1)
    posterior = (good + 1) / (good + bad + 2)
    table = np.zeros((cast.shape[1], 2, 2))
    for _ in range(steps):
        classes = np.stack([1 - posterior, posterior])  # bad, good
        mass = classes * weight
        table = np.einsum("cp,plv->lcv", mass, one_hot) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (mass.sum(axis=1) + 1.0) / (mass.sum() + 2.0)
        logs = np.log(prior)[:, None] + np.einsum("plv,lcv->cp", one_hot, np.log(table))
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return dict(zip(patterns, posterior.tolist())), table


_SHAPES = str.maketrans(
    {**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}}
)


def _word_features(word: str) -> tuple[int, int]:
    """Slots of the word's ending, and of its shape (repeats of a letter class once)."""
    shape = re.sub(r"(.)\1+", r"\1", word.translate(_SHAPES))
    return (
        zlib.crc32(("e" + word[-3:].lower()).encode()) % DIMENSIONS,
        zlib.crc32(("s" + shape[:8]).encode()) % DIMENSIONS,
    )


class Features:
    """Hashed features of texts; words met before are kept up to a limit."""

    def __init__(self, limit: int = 400_000):
        self._limit, self._known = limit, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Slots and weights of a whole text: log counts on unit length."""
        if len(self._known) > self._limit:
            self._known.clear()
        known, slots = self._known, []
        for word in (text or "").split():
            pair = known.get(word)
            if pair is None:
                pair = known[word] = _word_features(word)
            slots += pair
        found, counts = np.unique(np.array(slots, np.int32), return_counts=True)
        weights = np.log1p(counts)
        return found, weights / max(np.sqrt((weights**2).sum()), 1e-9)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, float]], good_share: float = 0.5, steps: int = 300
) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic scorer of posterior labels.

    Rows of either class weigh as many as the class has in the corpus, of which
    ``good_share`` is good: so one half is where either is as likely.
    """
    model = np.zeros(DIMENSIONS + 1)
    if not rows:
        model[-1] = 10.0  # nothing to learn from: all good
        return model
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    slots = np.concatenate([r[0] for r in rows])
    weights = np.concatenate([r[1] for r in rows])
    label = np.array([r[2] for r in rows])
    good = label > 0.5
    prior = np.clip(good_share, 0.02, 0.98)
    balance = np.where(good, prior / max(good.mean(), 1e-6), (1 - prior) / max(1 - good.mean(), 1e-6))
    step, speed = 4.0, np.zeros_like(model)
    for _ in range(steps):
        scores = np.bincount(owner, weights * model[slots], len(rows)) + model[-1]
        error = balance * (1 / (1 + np.exp(-scores)) - label) / len(rows)
        slope = np.append(np.bincount(slots, weights * error[owner], DIMENSIONS), error.sum())
        slope[:-1] += 1e-5 * model[:-1]
        speed = 0.9 * speed - step * slope
        model = model + speed
    return model


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        cast = [votes(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cast, pa.string())], names=["doc_id", "votes"])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in slices(batches):
        made = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([m[0] for m in made], pa.list_(pa.int32())),
                pa.array([m[1] for m in made], pa.list_(pa.float64())),
            ],
            names=["label", "slots", "weights"],
        )


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, votes, posterior) for all documents, and the linear model.

    Votes of all rows enter the label model. The linear scorer learns from at most
    ``train_rows`` rows of each class (posterior above or up to one half), those with
    the least hash of their doc_id: the one bounded sample here.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cast = written(own.mapInArrow(_vote_batches, "doc_id long, votes string"), "votes")
    counts = {r["votes"]: r["n"] for r in cast.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _ = label_model(counts) if counts else ({}, None)
    table = docs.sparkSession.createDataFrame(sorted(posterior.items()), "votes string, posterior double")
    labelled = written(cast.join(table, "votes"), "labelled")
    sample = None
    for side in (F.col("posterior") > 0.5, F.col("posterior") <= 0.5):
        part = labelled.where(side & F.col("doc_id").isNotNull())
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("doc_id", "posterior")
        sample = part if sample is None else sample.union(part)
    rows = (
        own.join(written(sample.dropDuplicates(["doc_id"]), "sample"), "doc_id")
        .select("posterior", "text")
        .mapInArrow(_feature_batches, "label double, slots array<int>, weights array<double>")
        .limit(2 * train_rows)
    )
    made = [(np.array(r[1], np.int64), np.array(r[2]), r[0]) for r in rows.collect()]
    made.sort(key=lambda r: (r[2], len(r[0]), r[0].tolist()))
    total = sum(counts.values())
    good = sum(n for pattern, n in counts.items() if posterior[pattern] > 0.5)
    return labelled, train(made, good / total if total else 0.5)


def _scores(features: Features, model: np.ndarray, texts: list[str | None]) -> list[float]:
    out = []
    for text in texts:
        slots, weights = features(text)
        out.append(float(1 / (1 + np.exp(-np.clip(weights @ model[slots] + model[-1], -50, 50)))))
    return out


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """(doc_id, votes, score) of each row of ``docs``; the model has a fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([votes(t) for t in texts], pa.string()),
                    pa.array(_scores(features, sent.value, texts), pa.float64()),
                ],
                names=["doc_id", "votes", "score"],
            )

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, votes string, score double")


def classify(docs: DataFrame) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) of each row of ``docs`` (doc_id, text).

    A null or empty text gets a bad vote of each labeller; repeated rows are scored
    alike; a null doc_id is scored but not trained on; an empty table gives no rows; a
    table of one class trains towards it; other columns are not read. Texts are read
    whole.
    """
    labelled, model = fit(docs)
    table = labelled.select("votes", "posterior").distinct()
    return score(docs, model).join(table, "votes", "left").select(
        "doc_id", "votes", "posterior", "score", (F.col("score") >= KEEP_FROM).alias("kept")
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, all columns as they are."""
    _, model = fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            scores = _scores(features, sent.value, batch.column(at).to_pylist())
            yield batch.filter(pa.array([s >= KEEP_FROM for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
