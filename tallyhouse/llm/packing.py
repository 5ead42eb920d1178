"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.shared import byte_bpe, slices

CAPACITY = 2048
# Tokens that are balanced together, and held by a task at a time.
GROUP_TOKENS = 4 << 20
# Attention cost of a piece of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 1024.0

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)

Piece = tuple[int, int, int, int, int]  # document, start, length, sequence, offset


def attention_cost(tokens: int) -> float:
    return tokens + tokens * tokens / QUADRATIC


def sequence_sizes(tokens: int, capacity: int) -> list[int]:
    """Full sequences, then the rest as powers of two, so that nothing is padded."""
    sizes, rest = [capacity] * (tokens // capacity), tokens % capacity
    while rest:
        sizes.append(1 << (rest.bit_length() - 1))
        rest -= sizes[-1]
    return sizes


class Open:
    """Open sequences by the room they have, and the cheapest with room enough.

    Sequences with the same room are a heap of (cost, sequence). A binary tree over all
    rooms holds in each node the cheapest of those below it, so that the cheapest with
    at least some room is found, and moved, in steps that grow with the logarithm of the
    capacity, whatever the number of sequences.
    """

    NONE = (float("inf"), -1)

    def __init__(self, capacity: int):
        self._leaves = 1 << max(capacity - 1, 1).bit_length()
        self._rooms: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self._tree = [self.NONE] * (2 * self._leaves)

    def _changed(self, room: int) -> None:
        tree, rows = self._tree, self._rooms[room]
        at = room - 1 + self._leaves
        tree[at] = rows[0] if rows else self.NONE
        while at > 1:
            at >>= 1
            left, right = tree[2 * at], tree[2 * at + 1]
            least = left if left <= right else right
            if tree[at] == least:
                break
            tree[at] = least

    def add(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self._rooms[room], (cost, sequence))
        if self._rooms[room][0][1] == sequence:
            self._changed(room)

    def cheapest(self, room: int) -> tuple[float, int]:
        """Cost and number of the cheapest sequence with at least so much room, or NONE."""
        tree, at = self._tree, room - 1 + self._leaves
        least = tree[at]
        while at > 1:
            if not at & 1 and tree[at + 1] < least:
                least = tree[at + 1]
            at >>= 1
        return least

    def take(self, room: int) -> None:
        """Take out the cheapest of the sequences with exactly that room."""
        heapq.heappop(self._rooms[room])
        self._changed(room)


def balance(lengths: list[int], capacity: int = CAPACITY) -> list[Piece]:
    """Place documents, dearest first, each on the cheapest sequence with room.

    Whole sequences are cut off long documents first. A document for which no sequence has
    room fills the cheapest one, and goes on as a further piece; together the
    sequences hold exactly all tokens.
    """
    sizes = sequence_sizes(sum(lengths), capacity)
    pieces: list[Piece] = []
    full = 0
    rest: list[tuple[int, int, int]] = []
    for document, length in enumerate(lengths):
        start = 0
        while length - start >= capacity:
            pieces.append((document, start, capacity, full, 0))
            start, full = start + capacity, full + 1
        if start < length:
            rest.append((length - start, document, start))
    rest.sort(key=lambda x: (-attention_cost(x[0]), x[1]))
    left = dict(enumerate(sizes[full:], full))
    open_ = Open(capacity)
    for sequence, room in left.items():
        open_.add(room, 0.0, sequence)
    for length, document, start in rest:
        while length:
            cost, sequence = open_.cheapest(length)
            if sequence < 0:  # none has room for all of it
                cost, sequence = open_.cheapest(1)
            room = left[sequence]
            taken = min(length, room)
            open_.take(room)
            pieces.append((document, start, taken, sequence, sizes[sequence] - room))
            left[sequence] = room - taken
            start, length = start + taken, length - taken
            if left[sequence]:
                open_.add(left[sequence], cost + attention_cost(taken), sequence)
    return pieces


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``capacity`` ids.

    A task packs groups of about ``group_tokens`` tokens as it reads them, so there
    is no shuffle, and no group depends on a key. A null or empty text is its end
    id alone; repeated rows are packed each; an empty table gives no rows; a null
    doc_id stays null; columns besides doc_id and text are not read. A row is
    (doc_id, start, length, doc_tokens, sequence_id, offset, ids), ids as
    little-endian unsigned 32-bit numbers.
    """
    schema = pa.schema(
        [(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES.fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, end = byte_bpe(vocabulary), np.array([end_id], "<u4").tobytes()
        # A task's sequences have numbers of their own: 2^38 of them for each task.
        next_sequence = TaskContext.get().partitionId() << 38
        keys: list[int | None] = []
        held: list[bytes] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, keys, held, tokens
            pieces = balance([len(ids) // 4 for ids in held], capacity)
            for at in range(0, len(pieces), 4096):
                part = pieces[at : at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[d] for d, *_ in part], pa.int64()),
                        pa.array([s for _, s, *_ in part], pa.int64()),
                        pa.array([n for _, _, n, _, _ in part], pa.int64()),
                        pa.array([len(held[d]) // 4 for d, *_ in part], pa.int64()),
                        pa.array([next_sequence + q for *_, q, _ in part], pa.int64()),
                        pa.array([o for *_, o in part], pa.int64()),
                        pa.array([held[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in part], pa.binary()),
                    ],
                    schema=schema,
                )
            next_sequence += 1 + max((q for *_, q, _ in pieces), default=-1)
            keys, held, tokens = [], [], 0

        for batch in slices(batches):
            keys += batch.column(0).to_pylist()
            for ids in bpe.encode([t or "" for t in batch.column(1).to_pylist()]):
                held.append(ids + end)
                tokens += len(ids) // 4 + 1
            if tokens >= group_tokens:
                yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
