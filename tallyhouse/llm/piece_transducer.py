"""SentencePiece encoding and decoding with weighted transducers."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import slices

SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6  # kinds of pieces in the model file, fixed
INFINITE = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = number() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class _Words(dict):
    """Ids of words, made at the first look-up."""

    def __init__(self, made: Callable[[str], bytes]):
        self._made = made

    def __missing__(self, word: str) -> bytes:
        data = self[word] = self._made(word)
        return data


class PieceTransducer:
    """Normaliser, pieces and byte fallback of a BPE model file, compiled to arcs.

    The normaliser maps a space to the space letter and puts one in front of the text;
    it is a transducer of one state. Pieces are the arcs of the second machine, with
    spelling in bytes for letters that are no piece. Its states remember the last piece:
    an arc has weight one if the last piece and the new one encode to themselves side by
    side, and infinity if not; merging by score never crosses such a border, so the one
    path of finite weight is the model's encoding. Composed with an input, the machine
    has a state for each position, and the shortest path in the tropical semiring
    (sums along a path, the least of all) is found from left to right. Merging gives a
    prefix one encoding, so a position has one incoming arc on a path of finite weight,
    and the search of a position ends there.

    The caches of words and of pairs are emptied at ``limit`` entries, so memory stays
    bounded; results do not depend on them.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        self._score: dict[str, float] = {}
        self._id: dict[str, int] = {}
        self._unknown = -1
        self.text: list[str | bytes] = []  # what a piece is decoded to
        for key, value in message:
            if key != 1:
                continue
            piece = dict(_fields(value))
            name, kind = piece[1].decode(), piece.get(3, _NORMAL)
            number = len(self.text)
            if kind == _NORMAL:
                self._id[name] = number
                self._score[name] = struct.unpack("<f", piece.get(2, b"\0" * 4))[0]
                self.text.append(name.replace(SPACE, " "))
            elif kind == _BYTE:
                self.text.append(bytes([int(name[3:5], 16)]))
            else:
                if kind == _UNKNOWN:
                    self._unknown = number
                self.text.append(" ⁇ " if kind == _UNKNOWN else "")
        self._byte = {t[0]: n for n, t in enumerate(self.text) if isinstance(t, bytes)}
        self._spells = np.array([isinstance(t, bytes) for t in self.text], bool)
        self._tails: dict[str, bool] = {}  # ends of pieces; true for whole ones
        for name in self._id:
            for at in range(len(name)):
                self._tails[name[at:]] = at == 0 or self._tails.get(name[at:], False)
        self._limit = limit
        self._weights: dict[tuple[str, str], float] = {}
        self._words = _Words(self._chunk_ids)

    def _merged(self, text: str) -> list[str]:
        """Merging by score, the leftmost of equal ones first."""
        parts = list(text)
        while True:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1], -INFINITE)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _weight(self, left: str, right: str) -> float:
        """Of the arc for the piece ``right`` in the state ``left`` (empty at the start)."""
        weight = self._weights.get((left, right))
        if weight is None:
            pair = [left, right] if left else [right]
            weight = 1.0 if self._merged(left + right) == pair else INFINITE
            self._weights[left, right] = weight
        return weight

    def _shortest(self, chunk: str) -> list[str]:
        """Pieces on the shortest path over one chunk, letters without a piece included."""
        tails, weights = self._tails, self._weights
        # By position: the position before, the last piece, and whether its weight is finite.
        before, last, finite = [0], [""], [True]
        for end in range(1, len(chunk) + 1):
            starts = [end - 1] if finite[end - 1] else []
            for start in range(end - 1, -1, -1):
                whole = tails.get(chunk[start:end])
                if whole is None:
                    break
                if whole and finite[start] and start < end - 1:
                    starts.append(start)
            best = end - 1
            ended = False
            for start in reversed(starts):
                pair = last[start], chunk[start:end]
                weight = weights.get(pair)
                if (self._weight(*pair) if weight is None else weight) != INFINITE:
                    best, ended = start, True
                    break
            before.append(best)
            last.append(chunk[best:end])
            finite.append(ended)
        pieces, at = [], len(chunk)
        while at:
            pieces.append(last[at])
            at = before[at]
        return pieces[::-1]

    def _chunk_ids(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self._shortest(chunk):
            number = self._id.get(piece)
            ids += [self._byte[b] for b in piece.encode()] if number is None else [number]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        for cache in (self._words, self._weights):
            if len(cache) > self._limit:
                cache.clear()
        # No piece has a space letter behind another letter: words are composed alone.
        return b"".join(map(self._words.__getitem__, _CHUNK.findall(SPACE + text.replace(" ", SPACE))))

    def decode(self, data: bytes) -> str:
        """The text of ids: the pieces' letters, runs of byte pieces read as UTF-8 with a
        replacement mark for each byte that is none, without the space put in front."""
        ids = np.frombuffer(data, "<u4")
        texts = [self.text[number] for number in ids.tolist()]
        parts, done = [], 0
        spelled = np.flatnonzero(self._spells[ids])
        if len(spelled):
            borders = np.flatnonzero(np.diff(spelled) > 1) + 1
            firsts, lasts = spelled[np.r_[0, borders]], spelled[np.r_[borders - 1, len(spelled) - 1]]
            for first, last in zip(firsts.tolist(), lasts.tolist()):
                parts += texts[done:first]
                done = last + 1
                parts.append(_utf8(b"".join(texts[first:done])))
        parts += texts[done:]
        start = next((at for at, text in enumerate(texts) if text), None)
        whole = "".join(parts)
        if start is None or isinstance(texts[start], bytes) or ids[start] == self._unknown:
            return whole
        return whole.removeprefix(" ")


@lru_cache(maxsize=1)
def compiled(path: str) -> PieceTransducer:
    """The machine of a model file; the tasks of one worker share it and its caches."""
    return PieceTransducer(path)


def _utf8(data: bytes) -> str:
    out = []
    while data:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as error:
            out += [data[: error.start].decode(), "�"]
            data = data[error.start + 1 :]
    return "".join(out)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text); ids as little-endian
    unsigned 32-bit numbers.

    A null text is empty and has no ids; repeated rows are encoded each; a null doc_id
    stays null; other columns are not read; an empty table gives no rows. Texts are
    read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model)
        for batch in slices(batches):
            ids = [machine.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) for each row of ``encoded`` (doc_id, ids); null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model)
        for batch in slices(batches):
            texts = [machine.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
            )

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")
