"""Counts of words and of neighbouring words, made per task before rows are shuffled."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a task holds before it hands its counts on, and rows it hands on at once.
HELD_WORDS, HANDED_ROWS = 4_000_000, 200_000
#: Different words that a task holds before it hands their counts on.
HELD_COUNTS = 400_000


def token_counts(df: DataFrame, tokens: str, word: str, n: str) -> DataFrame:
    """(word, n): how often each token of the arrays ``tokens`` occurs; a null token counts as one of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=[word, n])

    rows = df.select(tokens)
    kind = rows.schema[tokens].dataType.elementType.simpleString()
    return rows.mapInArrow(run, f"{word} {kind}, {n} long").groupBy(word).agg(F.sum(n).alias(n))


def word_counts(df: DataFrame, text: str, word: str, n: str, by: str | None = None, weight: str | None = None, held_counts: int = HELD_COUNTS) -> DataFrame:
    """(by, word, n): how often each word of ``text`` occurs, a row counting ``weight`` times. Words are those of ``functions.texts.words``."""
    group, times = F.col(by) if by else F.lit(None).cast("long"), F.col(weight) if weight else F.lit(1)
    rows = df.select(F.col(text).cast("string").alias("text"), group.alias("group"), times.cast("long").alias("times"))
    kind = rows.schema["group"].dataType
    arrow = pa.string() if kind.simpleString() == "string" else pa.int64()
    if kind.simpleString() not in ("string", "bigint"):
        raise ValueError(f"words are counted by texts or long numbers, not by {kind.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict = defaultdict(Counter)
        size = 0
        for batch in batches:
            for value, g, t in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                counts = held[g, t]
                size -= len(counts)
                # str.split() takes the same blanks for blanks as ``words`` does
                counts.update((value.as_py() or "").split())
                size += len(counts)
                if size >= held_counts:
                    yield from flush(held)
                    held, size = defaultdict(Counter), 0
        yield from flush(held)

    def flush(held):
        for (g, t), counts in held.items():
            numbers = np.fromiter(counts.values(), np.int64, len(counts)) * (t or 0)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(counts), arrow), pa.array(list(counts), pa.string()), pa.array(numbers)], names=["group", word, n])

    counted = rows.mapInArrow(run, f"group {kind.simpleString()}, {word} string, {n} long")
    if by is None:
        return counted.groupBy(word).agg(F.sum(n).alias(n))
    return counted.groupBy(F.col("group").alias(by), word).agg(F.sum(n).alias(n))


def neighbour_counts(df: DataFrame, text: str, first: str, second: str, n: str, held_words: int = HELD_WORDS) -> DataFrame:
    """(first, second, n): how often a word of ``text`` is followed by another. Words are those of ``functions.texts.words``.

    Pairs are numbers within a task, sorted and counted there; only different pairs become rows.
    """
    handed = HANDED_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def empty() -> tuple[list, defaultdict]:
            numbers: defaultdict = defaultdict()
            numbers.default_factory = numbers.__len__  # a new word takes the next number
            return [], numbers

        def flush():
            words = pa.array(list(numbers), pa.string())
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(keys), handed):
                k = keys[i : i + handed]
                parts = [words.take(pa.array(k >> 32)), words.take(pa.array(k & 0xFFFFFFFF)), pa.array(counts[i : i + handed].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(parts, names=[first, second, n])

        size = 0
        held, numbers = empty()
        for batch in batches:
            for value in batch.column(0):
                # str.split() takes the same blanks for blanks as ``words`` does
                found = (value.as_py() or "").split()
                if len(found) < 2:
                    continue
                ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
                held.append(ids[:-1] << 32 | ids[1:])
                size += len(found)
                if size >= held_words:
                    yield from flush()
                    held, numbers = empty()
                    size = 0
        if held:
            yield from flush()

    pairs = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, f"{first} string, {second} string, {n} long")
    return pairs.groupBy(first, second).agg(F.sum(n).alias(n))
