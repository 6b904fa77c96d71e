"""Strings of words that can meet in other documents: anchors, spots and contexts.

A string of ``length`` words has an anchor, its smallest ``gram``-word hash (the first of equal ones), which depends on the string alone. Consecutive strings mostly share it, so
a document is a list of *spots*: an anchor and a range of string starts, at most ``length - gram + 1``. The words that a spot's strings cover are its *context*, named by a hash.
Strings are equal only under equal anchors, and spots of one anchor and context repeat each other as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .suffix_dedup import Hasher, sliding_min

#: Words hashed at a time; places within them fit 24 bits.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_NAME = xxhash.xxh3_64_intdigest


def symbols(data: bytes) -> np.ndarray:
    """The hashes of a text's words."""
    words = data.split()
    return np.fromiter(map(_NAME, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def spots(texts: list[bytes], hasher: Hasher, length: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    """Arrays of equal length: ``row`` (of the text), ``anchor``, ``context``, first and last start ``a`` and ``b`` and the anchor's place ``p`` of each spot."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for t, text in enumerate(texts):
        sym = symbols(text)
        for at in range(0, max(len(sym) - length + 1, 0), PIECE):
            piece = sym[at : at + PIECE + length - 1]
            if held and size + len(piece) > PIECE + length:
                yield from _spots(held, hasher, length, gram)
                held, size = [], 0
            held.append((t, at, piece))
            size += len(piece)
    if held:
        yield from _spots(held, hasher, length, gram)


def _spots(held: list[tuple[int, int, np.ndarray]], hasher: Hasher, length: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    sym = np.concatenate([x[2] for x in held])
    sizes = np.array([len(x[2]) for x in held])
    ends = np.cumsum(sizes)
    total = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum((sym + np.uint64(1)) * hasher.up[: len(sym)], out=total[1:])
    grams = mixed((total[gram:] - total[:-gram]) * hasher.down[: len(sym) - gram + 1])
    places = np.arange(len(grams), dtype=np.uint64)
    low = sliding_min((grams & ~_PLACE) | places, length - gram + 1)
    start = np.arange(len(low))
    owner = np.repeat(np.arange(len(held)), sizes)[: len(low)]
    fits = start + length <= ends[owner]
    start, owner, place = start[fits], owner[fits], (low[fits] & _PLACE).astype(np.int64)
    if not len(start):
        return
    new = np.flatnonzero((place[1:] != place[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(start)]]) - 1
    a, b, o, p = start[first], start[last], owner[first], place[first]
    context = mixed((total[b + length] - total[a]) * hasher.down[a] + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    row = np.array([x[0] for x in held])
    shift = np.array([x[1] for x in held]) - (ends - sizes)
    yield {"row": row[o], "anchor": grams[p].view(np.int64), "context": context.view(np.int64), "a": a + shift[o], "b": b + shift[o], "p": p + shift[o]}


def find_spots(own: DataFrame, length: int, gram: int, places: bool = False) -> DataFrame:
    """``_id``, ``_h``, ``anchor``, ``context``, ``a``, ``b`` and, with ``places``, ``p`` of all spots of ``_text``."""
    names = ["anchor", "context", "a", "b", *(["p"] if places else [])]
    id_type = own.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE + 2 * length)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("_text").cast(pa.binary())]
            for out in spots(texts, hasher, length, gram):
                take = pa.array(out["row"])
                whole = pa.RecordBatch.from_arrays([batch.column("_id").take(take), batch.column("_h").take(take), *[pa.array(out[c], pa.int64()) for c in names]], names=["_id", "_h", *names])
                for k in range(0, whole.num_rows, 50_000):
                    yield whole.slice(k, 50_000)

    return own.select("_id", "_h", "_text").mapInArrow(run, f"_id {id_type}, _h long, " + ", ".join(f"{c} long" for c in names))
