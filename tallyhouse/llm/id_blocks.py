"""Token ids in blocks, compressed by a context-mixing range coder.

A block is a header and a payload. Header: magic, version, number of ids, of documents
and of distinct slots, CRC-32 of the ids, sizes of the parts; then the documents' keys
and lengths, the payload's sizes by lane, and the payload. Each block is decoded alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import byte_bpe, slices, written

MAGIC = b"IDBLK1\0\0"
_HEADER = struct.Struct("<8sQQQIQQ")
BLOCK_IDS = 1 << 19
LANES = 2048
PAIR_SLOTS = 1 << 18  # of the order-2 table
CONFIDENCE = 7
_GAIN = 24  # what an id adds to its order-0 count
_TOP, _BOTTOM, _WORD = np.uint64(48), np.uint64(1) << np.uint64(32), np.uint64(16)
_SETTLED = np.uint64(1) << _TOP  # two numbers that differ by less bits share their first word
_ONE = np.uint64(1)
_TRUST = 3  # bits of a guess's confidence, below the guess
# What a confidence gains if its guess is wrong, then what it gains if it is right.
_TRUSTS = np.arange(CONFIDENCE + 1)
_GAINS = np.concatenate([(_TRUSTS >> 1) - _TRUSTS, np.minimum(_TRUSTS + 1, CONFIDENCE) - _TRUSTS])
_NEAR = 3  # bits of an id within its run of counts


class _Predictor:
    """Adaptive predictions of the next id of many lanes at once.

    The last id seen after the last two ids (order 2) and after the last one (order 1)
    are guesses with a confidence each. Counters for each pair of confidences mix them:
    how often the first guess, the second, or neither came true. If neither does, the id
    is coded by its count so far (order 0). All tables learn after each step, from the
    ids of all lanes, alike when encoding and decoding.
    """

    def __init__(self, kinds: int, lanes: int):
        self.guess2 = np.zeros(PAIR_SLOTS, np.int64)  # guesses, and their confidence in the low bits
        self.guess1 = np.zeros(kinds, np.int64)
        self.outcomes = np.ones((CONFIDENCE + 1) ** 2 * 2 * 3, np.int64)  # three for each mix
        # Counts by place in a run and run, and what lies below: within the run, and below it.
        self.runs = -(-kinds >> _NEAR)
        self.counts = np.zeros((1 << _NEAR) * self.runs, np.uint64)
        self.counts[self._places(np.arange(kinds))] = 1
        self.within = np.zeros(((1 << _NEAR) + 1, self.runs), np.uint64)
        self._rows = [*zip(self.within, self.counts.reshape(-1, self.runs), self.within[1:])]
        self.below = np.zeros(self.runs + 1, np.uint64)
        self._add_up()
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def _places(self, ids: np.ndarray) -> np.ndarray:
        return (ids & ((1 << _NEAR) - 1)) * self.runs + (ids >> _NEAR)

    def _add_up(self) -> None:
        """Sums over few long rows, since one sum along all ids can't use the processor's vectors."""
        for below, counts, above in self._rows:
            np.add(below, counts, out=above)
        np.cumsum(self.within[-1], out=self.below[1:])

    def range_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the ids below each id, and its own."""
        places = self._places(ids)
        return self.below[ids >> _NEAR] + self.within.ravel()[places], self.counts[places]

    def at(self, points: np.ndarray) -> np.ndarray:
        """The ids in whose counts the points lie."""
        run = np.searchsorted(self.below, points, "right") - 1
        rest, within, near = points - self.below[run], self.within.ravel(), np.zeros(len(points), np.int64)
        for bit in reversed(range(_NEAR)):
            near += (within[(near + (1 << bit)) * self.runs + run] <= rest) * np.int64(1 << bit)
        return (run << _NEAR) + near

    def guess(self, n: int) -> None:
        last = self.last[:n]
        self.slot = (self.before[:n] * 40503 + last * 2654435761) & (PAIR_SLOTS - 1)
        self.entry2, self.entry1 = self.guess2[self.slot], self.guess1[last]
        self.first, self.second = self.entry2 >> _TRUST, self.entry1 >> _TRUST
        self.trust2, self.trust1 = self.entry2 & CONFIDENCE, self.entry1 & CONFIDENCE
        agree = self.first == self.second
        self.mix = ((self.trust2 * (CONFIDENCE + 1) + self.trust1) * 2 + agree) * 3
        self.shares = self.outcomes.astype(np.uint64)
        self.edges = np.cumsum(self.shares.reshape(-1, 3), axis=1).ravel()
        self.total = self.edges[self.mix + 2]

    def learn(self, n: int, ids: np.ndarray, coded: np.ndarray) -> None:
        """``coded`` is the place of each lane's outcome among the outcomes."""
        self.outcomes += 16 * np.bincount(coded, minlength=len(self.outcomes))
        by_mix = self.outcomes.reshape(-1, 3)
        crowded = by_mix.sum(axis=1) > 1 << 16
        if crowded.any():
            by_mix[crowded] = (by_mix[crowded] + 1) >> 1
        last, fresh = self.last[:n].copy(), ids << _TRUST
        for guesses, slots, entry, trust, guess in (
            (self.guess2, self.slot, self.entry2, self.trust2, self.first),
            (self.guess1, last, self.entry1, self.trust1, self.second),
        ):
            trust += (guess == ids) * np.int64(CONFIDENCE + 1)
            entry += _GAINS[trust]
            np.copyto(entry, fresh, where=trust == 0)
            guesses[slots] = entry
        np.add.at(self.counts, self._places(ids), np.uint64(_GAIN))
        self._add_up()
        self.before[:n], self.last[:n] = last, ids


def _shape(total: int) -> tuple[int, int, int]:
    """Lanes that are full, ids in a full lane, ids in the lane behind them."""
    length = max(1, -(-total // LANES))
    return total // length, length, total % length


class _Encoder:
    def __init__(self, lanes: int, length: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.room = 4 * length + 8
        self.words = np.zeros(lanes * self.room, np.uint16)
        self.at = np.arange(lanes) * self.room

    def code(self, lanes: np.ndarray | slice, start: np.ndarray, share: np.ndarray, total: np.ndarray) -> None:
        unit = self.range[lanes] // total
        low, range_ = self.low[lanes] + start * unit, share * unit
        self.low[lanes], self.range[lanes] = low, range_
        open_, range_ = _open_lanes(low, range_)
        lanes, low = open_ if isinstance(lanes, slice) else lanes[open_], low[open_]
        while len(open_):
            at = self.at[lanes]
            self.words[at] = low >> _TOP
            self.at[lanes] = at + 1
            low, range_ = low << _WORD, range_ << _WORD
            self.low[lanes], self.range[lanes] = low, range_
            open_, range_ = _open_lanes(low, range_)
            lanes, low = lanes[open_], low[open_]

    def finish(self) -> tuple[np.ndarray, bytes]:
        for _ in range(4):
            self.words[self.at] = self.low >> _TOP
            self.at += 1
            self.low <<= _WORD
        size = self.at - np.arange(len(self.low)) * self.room
        used = np.arange(self.room) < size[:, None]
        return size, self.words.reshape(-1, self.room)[used].astype("<u2").tobytes()


class _Decoder:
    def __init__(self, sizes: np.ndarray, payload: bytes):
        lanes = len(sizes)
        self.words = np.frombuffer(payload + b"\0" * 16, "<u2").astype(np.uint64)
        self.at = np.cumsum(sizes) - sizes
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.value = np.zeros(lanes, np.uint64)
        for _ in range(4):
            self.value = (self.value << _WORD) | self.words[self.at]
            self.at += 1

    def ahead(self, lanes: np.ndarray | slice, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far each lane's value lies above its low end, and what one of the total takes."""
        self._unit = self.range[lanes] // total
        return self.value[lanes] - self.low[lanes], self._unit

    def take(self, lanes: np.ndarray | slice, start: np.ndarray, share: np.ndarray) -> None:
        low, range_ = self.low[lanes] + start * self._unit, share * self._unit
        self.low[lanes], self.range[lanes] = low, range_
        open_, range_ = _open_lanes(low, range_)
        lanes, low = open_ if isinstance(lanes, slice) else lanes[open_], low[open_]
        while len(open_):
            at = self.at[lanes]
            self.value[lanes] = (self.value[lanes] << _WORD) | self.words[at]
            self.at[lanes] = at + 1
            low, range_ = low << _WORD, range_ << _WORD
            self.low[lanes], self.range[lanes] = low, range_
            open_, range_ = _open_lanes(low, range_)
            lanes, low = lanes[open_], low[open_]


def _open_lanes(low: np.ndarray, range_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lanes whose first word is settled, and their ranges; a range that has
    become small across a border of words is cut at it."""
    apart = low ^ (low + range_)
    open_ = apart < _SETTLED
    small = range_ < _BOTTOM
    if small.any():
        small &= ~open_
        open_ |= small
        range_ = np.where(small, (~low + _ONE) & (_BOTTOM - _ONE), range_)
    open_ = open_.nonzero()[0]
    return open_, range_[open_]


def encode_ids(ids: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """Number of kinds, words by lane and payload of ids (any unsigned below 2^31)."""
    ids = ids.astype(np.int64)
    if not len(ids):
        return 0, np.zeros(0, np.int64), b""
    kinds = int(ids.max()) + 1
    full, length, rest = _shape(len(ids))
    lanes = full + (rest > 0)
    table = np.zeros((lanes, length), np.int64)
    table.ravel()[: len(ids)] = ids
    steps = np.ascontiguousarray(table.T)
    model, coder = _Predictor(kinds, lanes), _Encoder(lanes, length)
    for step in range(length):
        n = full + (step < rest)
        model.guess(n)
        now = steps[step, :n]
        missed = now != model.first
        coded = model.mix + missed
        missed &= now != model.second
        coded += missed
        share = model.shares[coded]
        coder.code(slice(n), model.edges[coded] - share, share, model.total)
        missed = missed.nonzero()[0]
        if len(missed):
            coder.code(missed, *model.range_of(now[missed]), model.below[-1])
        model.learn(n, now, coded)
    return kinds, *coder.finish()


def decode_ids(total: int, kinds: int, sizes: np.ndarray, payload: bytes) -> np.ndarray:
    if not total:
        return np.zeros(0, np.int64)
    full, length, rest = _shape(total)
    lanes = full + (rest > 0)
    steps = np.zeros((length, lanes), np.int64)
    model, coder = _Predictor(kinds, lanes), _Decoder(sizes, payload)
    for step in range(length):
        n = full + (step < rest)
        model.guess(n)
        ahead, unit = coder.ahead(slice(n), model.total)
        wrong = ahead >= model.edges[model.mix] * unit
        missed = ahead >= model.edges[model.mix + 1] * unit
        coded = model.mix + wrong
        coded += missed
        share = model.shares[coded]
        coder.take(slice(n), model.edges[coded] - share, share)
        now = np.where(wrong, model.second, model.first)
        missed = missed.nonzero()[0]
        if len(missed):
            ahead, unit = coder.ahead(missed, model.below[-1])
            point = np.minimum(ahead // unit, model.below[-1] - _ONE)
            wanted = model.at(point)
            coder.take(missed, *model.range_of(wanted))
            now[missed] = wanted
        steps[step, :n] = now
        model.learn(n, now, coded)
    return steps.T.ravel()[:total]


def write_block(keys: list[int | None], documents: list[np.ndarray]) -> bytes:
    """One block of whole documents (their ids as unsigned 32-bit numbers)."""
    ids = np.concatenate([*documents, np.zeros(0, "<u4")]).astype("<u4")
    kinds, sizes, payload = encode_ids(ids)
    heads = zlib.compress(
        np.array([k is None for k in keys], np.uint8).tobytes()
        + np.array([k or 0 for k in keys], "<i8").tobytes()
        + np.array([len(d) for d in documents], "<i8").tobytes()
    )
    lanes = zlib.compress(sizes.astype("<i8").tobytes())
    body = heads + lanes + payload
    head = _HEADER.pack(MAGIC, len(ids), len(keys), kinds, zlib.crc32(ids.tobytes()), len(heads), len(lanes))
    return head + body + struct.pack("<I", zlib.crc32(head + body))


def read_block(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Keys and ids of a block's documents; an error if a checksum does not hold."""
    magic, total, count, kinds, crc, heads, lanes = _HEADER.unpack_from(data)
    if magic != MAGIC or struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
        raise ValueError("not a whole block of ids")
    at = _HEADER.size
    fields = zlib.decompress(data[at : at + heads])
    sizes = np.frombuffer(zlib.decompress(data[at + heads : at + heads + lanes]), "<i8")
    ids = decode_ids(total, kinds, sizes, data[at + heads + lanes : -4]).astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("ids do not match their checksum")
    null = np.frombuffer(fields, np.uint8, count)
    keys = np.frombuffer(fields, "<i8", count, count)
    lengths = np.frombuffer(fields, "<i8", count, count + 8 * count)
    cut = np.split(ids, np.cumsum(lengths)[:-1]) if count else []
    return [None if n else int(k) for n, k in zip(null, keys)], cut


def write_ids(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """The written blocks of ``docs`` (doc_id, text): part, block, data.

    Documents are dealt by ranges of doc_id, nulls first, sorted, encoded and written by
    Spark's own writer, so parts and blocks in order hold them in ascending order and a
    lost task is written anew. A block closes at BLOCK_IDS ids and holds whole
    documents. A null text is its end id alone; repeated rows are written each; an empty
    table has no blocks; other columns are not read.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, part, block = byte_bpe(vocabulary), TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([write_block(keys, held)], pa.binary())],
                names=["part", "block", "data"],
            )

        for batch in slices(batches):
            found = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            for key, ids in zip(batch.column(0).to_pylist(), found):
                keys.append(key)
                held.append(np.frombuffer(ids + end, "<u4"))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    keys, held, size, block = [], [], 0, block + 1
        if held:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(dealt.mapInArrow(run, "part long, block long, data binary"), "blocks")


def read_ids(blocks: DataFrame) -> DataFrame:
    """(part, block, doc_id, at, ids) of each document of written blocks; ``at`` is the
    number of ids before it in its block, ids are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            keys, documents = read_block(batch.column(2)[0].as_py())
            lengths = np.array([len(d) for d in documents], np.int64)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column(0)[0].as_py()] * n, pa.int64()),
                    pa.array([batch.column(1)[0].as_py()] * n, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(np.cumsum(lengths) - lengths),
                    pa.array([d.tobytes() for d in documents], pa.binary()),
                ],
                names=["part", "block", "doc_id", "at", "ids"],
            )

    return blocks.select("part", "block", "data").mapInArrow(
        run, "part long, block long, doc_id long, at long, ids binary"
    )


def placed(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents read back from blocks; start
    counts the ids of all documents before. One total per part comes to the driver."""
    found = written(
        read_ids(blocks).select(
            "part",
            "block",
            "doc_id",
            "at",
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        ),
        "read",
    )
    sizes = written(found.groupBy("part", "block").agg(F.sum("n_tokens").alias("n")), "sizes")
    parts, before, offsets = sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect(), 0, []
    for row in parts:
        offsets.append((row["part"], before))
        before += row["n"]
    table = blocks.sparkSession.createDataFrame(offsets, "part long, part_start long")
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("block_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(table, "part")
    return found.join(starts.drop("n"), ["part", "block"]).select(
        "doc_id", (F.col("part_start") + F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
