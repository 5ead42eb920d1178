"""Exact token counts of every prefix of a text, by dynamic programming."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.shared import byte_letters, slices, words_of

# The split pattern of the vocabulary file, fixed.
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_WHITE_RUN = regex.compile(r"\p{White_Space}{2,}")
_LONG_ENDINGS = {"'re", "'ve", "'ll"}
_STEP = np.dtype("=i2")


class PrefixCounts:
    """Token counts of all prefixes under a byte-level BPE file.

    For each prefix of a piece the last token of its encoding is kept. It is the
    one token that ends the prefix and stands next to the last token of what lies
    before it, that is, the two encode to themselves side by side; so a prefix costs
    one step from shorter ones, and its count is theirs plus one. Counts of a text
    are sums over its pieces. Where a prefix would be split in another way than the
    whole text (within white space, contractions, special strings), the count is
    that of the prefix as a text of its own.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        special = {t["content"] for t in data["added_tokens"]}
        self._ids = {
            bytes(letters[c] for c in piece): number
            for piece, number in data["model"]["vocab"].items()
            if piece not in special
        }
        self._bytes = {number: piece for piece, number in self._ids.items()}
        self._ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = bytes(letters[c] for c in left), bytes(letters[c] for c in right)
            self._ranks[self._ids[a], self._ids[b]] = (rank, self._ids[a + b])
        self._special = sorted(special, key=lambda s: (-len(s), s))
        self._find_special = regex.compile("|".join(map(regex.escape, self._special))) if special else None
        # For the last four bytes of a prefix, the lengths that tokens with this end have.
        ends: dict[bytes, set[int]] = {}
        for piece in self._ids:
            if len(piece) >= 4:
                ends.setdefault(piece[-4:], {3, 2, 1}).add(len(piece))
        self._lengths = {end: tuple(sorted(found, reverse=True)) for end, found in ends.items()}
        self._limit = limit
        self._beside: dict[int, bool] = {}
        self._words: dict[str, bytes] = {}

    def _merge(self, data: bytes) -> list[int]:
        ids = [self._ids[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            found = [(self._ranks[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in self._ranks]
            if not found:
                break
            (_, merged), at = min(found)
            ids[at : at + 2] = [merged]
        return ids

    def _fits(self, left: int, right: int) -> bool:
        fits = self._merge(self._bytes[left] + self._bytes[right]) == [left, right]
        self._beside[left << 24 | right] = fits
        return fits

    def _grow(self, piece: bytes) -> list[int]:
        """Count for each prefix of a piece, shortest first."""
        token_of, beside, lengths = self._ids.get, self._beside.get, self._lengths.get
        last: list[int] = []
        counts: list[int] = []
        for end in range(1, len(piece) + 1):
            for size in lengths(piece[end - 4 : end], (3, 2, 1)) if end >= 4 else range(end, 0, -1):
                start = end - size
                if start < 0 or (token := token_of(piece[start:end])) is None:
                    continue
                if not start:  # a token encodes to itself
                    last.append(token)
                    counts.append(1)
                    break
                left = last[start - 1]
                fits = beside(left << 24 | token)
                if self._fits(left, token) if fits is None else fits:
                    last.append(token)
                    counts.append(counts[start - 1] + 1)
                    break
            else:
                raise ValueError("no token ends this prefix")
        return counts

    def _piece(self, piece: str) -> list[int]:
        """Counts after each character of a piece taken alone."""
        rows = self._grow(piece.encode())
        if len(rows) == len(piece):
            return rows
        counts, at = [], 0
        for character in piece:
            at += len(character.encode())
            counts.append(rows[at - 1])
        return counts

    def _plain(self, text: str) -> list[int]:
        """Counts after each character of a text without special strings."""
        out: list[int] = []
        total = 0
        for piece in PIECE.findall(text):
            counts = self._piece(piece)
            if piece in _LONG_ENDINGS:
                counts[1] = 2
            out += [count + total for count in counts] if total else counts
            total = out[-1]
        for run in _WHITE_RUN.finditer(text):
            before = out[run.start() - 1] if run.start() else 0
            out[run.start() : run.end()] = [before + count for count in self._piece(run.group())]
        return out

    def counts(self, text: str) -> np.ndarray:
        """Token counts after each character of a text."""
        return np.cumsum(np.frombuffer(self.steps([text])[0], _STEP), dtype=np.int64)

    def _with_special(self, text: str) -> list[int]:
        out: list[int] = []
        base = at = 0
        for found in self._find_special.finditer(text):
            open_ = [base + count for count in self._plain(text[at : found.end() - 1])]
            before = found.start() - at
            base = (open_[before - 1] if before else base) + 1
            out += [*open_, base]
            at = found.end()
        return out + [base + count for count in self._plain(text[at:])]

    def _changes(self, counts: list[int]) -> bytes:
        return array("h", map(sub, counts, [0, *counts])).tobytes()

    def steps(self, texts: Sequence[str]) -> list[bytes]:
        """Per text the change of the count at each character, as native 16-bit numbers."""
        for cache in (self._words, self._beside):
            if len(cache) > self._limit:
                cache.clear()
        known, out = self._words, []
        for text in texts:
            if self._find_special and self._find_special.search(text):
                out.append(self._changes(self._with_special(text)))
                continue
            words = words_of(text)
            found = [known.get(word) for word in words]
            found[0] = self._changes(self._plain(words[0]))
            if None in found:
                for at, word in enumerate(words):
                    if found[at] is None:
                        found[at] = known[word] = self._changes(self._plain(" " + word))
            out.append(b"".join(found))
        return out


@lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    """One for all tasks of a worker process, with the words it has met."""
    return PrefixCounts(path)


def token_counts(
    docs: DataFrame, vocabulary: str, budgets: Sequence[int] = (1024,), table: bool = False
) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text), read from the counts of their prefixes.

    Returns doc_id, n_bytes, n_tokens, for each budget ``chars_within_<budget>``
    (characters of the longest prefix that encodes to no more tokens), and with
    ``table`` the column ``steps``: the change of the count at each character, as
    little-endian 16-bit numbers. A null text is empty; repeated rows are counted
    each; a null doc_id stays null; other columns are not read; an empty table gives
    no rows. Each text is read whole, whatever its length.
    """
    fields = ["doc_id long", "n_bytes long", "n_tokens long"]
    fields += [f"chars_within_{budget} long" for budget in budgets] + ["steps binary"] * table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = prefix_counts(vocabulary)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            steps = prefixes.steps(texts)
            n_tokens, within = [], {budget: [] for budget in budgets}
            for data in steps:
                counts = np.cumsum(np.frombuffer(data, _STEP), dtype=np.int64)
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                for budget in budgets:
                    if n_tokens[-1] <= budget:
                        within[budget].append(len(counts))
                    else:
                        fitting = np.flatnonzero(counts <= budget)
                        within[budget].append(int(fitting[-1]) + 1 if len(fitting) else 0)
            columns = [
                batch.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(n_tokens, pa.int64()),
                *(pa.array(values, pa.int64()) for values in within.values()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", *(f"chars_within_{b}" for b in budgets)]
            if table:
                columns.append(pa.array(steps, pa.binary()))
                names.append("steps")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType.fromDDL(", ".join(fields))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
