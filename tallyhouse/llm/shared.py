"""Helpers of the operators here: the shared folder, written frames and byte-BPE ids."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

# Rows a task turns into Python objects at a time.
SLICE = 256


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as Parquet in the shared folder, read back: lineage is cut, and a
    lost executor costs no earlier stage."""
    spark = frame.sparkSession
    folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns under names of their own, next to the needed ones it has.

    So columns an operator makes can't clash with given ones. The list brings the given
    columns back, as they were.
    """
    columns = [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]
    held = [column.alias(f"given_{i}") for i, column in enumerate(columns)]
    present = [F.col(name).alias(name) for name in needed if name in docs.columns]
    back = [F.col(f"given_{i}").alias(name) for i, name in enumerate(docs.columns)]
    return docs.select(*held, *present), back


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabulary files write bytes: printable ones
    stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class ByteBpe:
    """Ids of a byte-level BPE file, a cache of words in front of the library.

    A space between two characters that are no white space always begins a piece
    of the pre-tokenizer, so texts are cut there and each word is encoded once.
    Texts with a special string go to the library whole. The cache is emptied at
    ``limit`` words, so memory stays bounded; results do not depend on it.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            self._begins[number] = piece.startswith("Ġ")  # a space, as the format writes it
        self._letters = byte_letters()
        self._limit = limit
        self._words: dict[str, bytes] = {}

    def spelled(self, number: int) -> bytes:
        """The bytes of an id."""
        return bytes(self._letters[c] for c in self._library.id_to_token(number))

    def _whole(self, text: str) -> bytes:
        ids = self._library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode words that follow a space, all in one call."""
        text = " " + " ".join(words)
        found = self._library.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        at = np.flatnonzero(self._begins[ids])
        if len(at) != len(words):
            raise ValueError("a word has more than one leading space")
        data, ends = ids.tobytes(), [*(at[1:] * 4).tolist(), len(ids) * 4]
        begin = 0
        for word, end in zip(words, ends):
            self._words[word] = data[begin:end]
            begin = end

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self._words) > self._limit:
            self._words.clear()
        known = self._words
        known[""] = known.get("") or self._whole(" ")
        cut: list[list[str] | None] = []
        held: list[list[bytes | None]] = []
        new: set[str] = set()
        for text in texts:
            if any(special in text for special in self._special):
                cut.append(None)
                held.append([self._whole(text)])
                continue
            words = words_of(text)
            # One look-up a word; the first one follows no space.
            found = list(map(known.get, words))
            found[0] = self._whole(words[0])
            if None in found:
                new.update(word for word, ids in zip(words, found) if ids is None)
                cut.append(words)
            else:
                cut.append(None)
            held.append(found)
        clean = [w for w in new if " " not in w and not _EDGE(w)]
        if clean:
            self._learn(clean)
        for word in new.difference(clean):
            known[word] = self._whole(" " + word)
        return [
            b"".join(found)
            if words is None
            else b"".join([known[word] if ids is None else ids for word, ids in zip(words, found)])
            for words, found in zip(cut, held)
        ]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One for all tasks of a worker process, with the words it has met."""
    return ByteBpe(path)


_RUN = re.compile(r"\s\s").search
_EDGE = re.compile(r"^\s|\s$").search
_CLEAN = re.compile(r"(?<=\S) (?=\S)")


def words_of(text: str) -> list[str]:
    """The text cut at single spaces; runs of white space stay within a word."""
    return _CLEAN.split(text) if _RUN(text) else text.split(" ")
