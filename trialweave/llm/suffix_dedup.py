"""Removes every byte covered by a long string that the corpus has more than once.

Strings of ``length`` bytes are judged, inside documents, on the input. Exactly, and without a suffix of every byte:

1. *Anchors.* A string's anchor is its smallest ``GRAM``-byte hash (the first of equal ones), a function of the string alone. Consecutive strings mostly
   share it, so a document is a list of spots: an anchor and the range of strings it stands for, whose bytes together are the spot's context.
   Strings can be equal only under equal anchors, so spots whose anchor is nowhere else are done.
2. *Equal contexts.* Spots with the same anchor and the same context (by hash) repeat each other as a whole. Counted with partial sums,
   so a thousand copies of a text cost one row per task.
3. *Suffix arrays.* Where an anchor has several contexts, one of each is cut, from the anchor, into blocks of ``BLOCK`` bytes, and blocks are numbered.
   ``suffix_sort`` orders the suffixes of these symbols; neighbours that agree for ``length / BLOCK - 1`` blocks share the inside of a string, and what
   lies before and behind it in the two broken blocks tells which strings are equal, by hash. Contexts are sorted together with others of their
   anchor, in batches of bounded size.
4. An anchor with more than ``most_contexts`` contexts goes another exact way: its strings are counted by hash.
5. Ranges of repeated strings return to their documents, where they are united and cut out.

Defined results: null texts are empty; documents shorter than ``length`` lose nothing; a string may overlap its other place; rows that are equal in id and text
are two places, so both lose all they share; removal may split a multi-byte character (``bytes`` are exact, ``text`` drops its rest).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import batches_of, join_text, keyed, materialize, read, schema_with, sorted_groups
from .suffix_sort import suffix_array

LENGTH, GRAM, BLOCK = 400, 32, 40
#: Texts are hashed in pieces of this size; places within a piece fit 24 bits.
PIECE = 1 << 20
MOST_CONTEXTS = 20_000
_B = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, np.uint64(base))
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Hasher:
    """Hashes of all grams of a byte string."""

    def __init__(self, most: int):
        self.up = _powers(_B, most + 1)
        self.down = _powers(pow(_B, -1, 1 << 64), most + 1)

    def grams(self, data: np.ndarray, size: int) -> np.ndarray:
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        h = (total[size:] - total[:-size]) * self.down[: n - size + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def spots(texts: list[bytes], hasher: Hasher, length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, anchor, context, first string, last string, place of the anchor) of each spot of some texts."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for t, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            piece = text[at : at + PIECE + length - 1]
            if size + len(piece) > PIECE + length and held:
                yield from _spots(held, hasher, length)
                held, size = [], 0
            held.append((t, at, piece))
            size += len(piece)
    if held:
        yield from _spots(held, hasher, length)


def _spots(held: list[tuple[int, int, bytes]], hasher: Hasher, length: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    joined = b"".join(x[2] for x in held)
    sizes = np.array([len(x[2]) for x in held])
    ends = np.cumsum(sizes)
    data = np.frombuffer(joined, np.uint8)
    grams = hasher.grams(data, GRAM)
    places = np.arange(len(grams), dtype=np.uint64)
    low = sliding_min((grams & ~_PLACE) | places, length - GRAM + 1)
    start = np.arange(len(low))
    owner = np.searchsorted(ends, start, "right")
    valid = start + length <= ends[owner]
    start, owner, anchor = start[valid], owner[valid], (low[valid] & _PLACE).astype(np.int64)
    if not len(start):
        return
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(start)]]) - 1
    begins = ends - sizes
    for a, b, p, o in zip(start[first].tolist(), start[last].tolist(), anchor[first].tolist(), owner[first].tolist()):
        t, at, _ = held[o]
        shift = at - int(begins[o])
        context = xxhash.xxh3_64_intdigest(joined[a : b + length], seed=p - a) - (1 << 63)
        yield t, int(grams[p].view(np.int64)), context, a + shift, b + shift, p + shift


def find_spots(own: DataFrame, length: int = LENGTH) -> DataFrame:
    """``_id``, ``_h``, ``anchor``, ``context``, first and last string ``a`` and ``b``, place ``p`` of the anchor: all spots of ``_text``."""
    id_type = own.schema["_id"].dataType.simpleString()
    own = own.select("_id", "_h", "_text")
    schema = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("p", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE + 2 * length)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("_text").cast(pa.binary())]
            for out in batches_of(spots(texts, hasher, length), schema, 20_000):
                take = out.column("row")
                yield pa.RecordBatch.from_arrays([batch.column("_id").take(take), batch.column("_h").take(take), *out.columns[1:]], names=["_id", "_h", *schema.names[1:]])

    return own.mapInArrow(run, f"_id {id_type}, _h long, anchor long, context long, a long, b long, p long")


def _ranges(flags: np.ndarray) -> list[int]:
    """Starts and ends (inclusive) of the stretches that are set, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    edges[1::2] -= 1
    return edges.tolist()


def repeated_strings(contexts: list[bytes], anchors: list[int], length: int = LENGTH, block: int = BLOCK) -> list[np.ndarray]:
    """For each context, which of its strings some other context has as well. ``anchors``: the anchor's place in each.

    ``length`` is a multiple of ``block``. Blocks are counted from the anchor, so equal strings of one anchor are cut alike.
    """
    inside = length // block - 1
    names: dict[bytes, int] = {}
    symbols, owner, place = [], [], []
    for c, (data, p) in enumerate(zip(contexts, anchors)):
        for q in range(p % block, len(data) - block + 1, block):
            symbols.append(names.setdefault(data[q : q + block], len(names)))
            owner.append(c)
            place.append(q)
        symbols.append(-1 - c)  # ends this context; smaller than all blocks and like no other
        owner.append(c)
        place.append(-1)
    flags = [np.zeros(len(data) - length + 1, bool) for data in contexts]
    s = np.array(symbols, np.int64)
    order = suffix_array(s - s.min())
    owner, place = np.array(owner), np.array(place)
    padded = np.concatenate([s, np.full(inside, -len(s) - 2)])
    same = np.ones(len(order) - 1, bool)
    for k in range(inside):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    run = np.concatenate([[0], np.cumsum(~same)])
    many = np.bincount(run)[run] > 1
    at, run = order[many], run[many]
    if not len(at):
        return flags
    # the string that begins r bytes before the block: r bytes before it, block - r bytes behind the inside
    m = len(at)
    before = np.zeros((m, block), np.uint64)
    behind = np.zeros((m, block), np.uint64)
    room = np.zeros(m, np.int64)
    most = np.zeros(m, np.int64)
    for i, (c, q) in enumerate(zip(owner[at].tolist(), place[at].tolist())):
        data = contexts[c]
        left = data[max(0, q - block + 1) : q]
        room[i] = len(left)
        before[i, : len(left)] = np.frombuffer(left, np.uint8)[::-1]
        right = data[q + inside * block : q + length]
        behind[i, : len(right)] = np.frombuffer(right, np.uint8)
        most[i] = q + length - len(data)  # fewer bytes before the block would pass the end
    up = _powers(_B, block)
    left = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum((before + np.uint64(1)) * up, axis=1, dtype=np.uint64)[:, :-1]], axis=1)
    right = np.cumsum((behind + np.uint64(1)) * up, axis=1, dtype=np.uint64)[:, ::-1]
    r = np.arange(block)
    ok = (r <= room[:, None]) & (r >= most[:, None])
    key = (left * np.uint64(0xD6E8FEB86659FD93)) ^ right
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + (run[:, None] * block + r).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    key ^= key >> np.uint64(29)
    rows, shift = np.nonzero(ok)
    _, inverse, n = np.unique(key[rows, shift], return_inverse=True, return_counts=True)
    hit = n[inverse] > 1
    for c, begin in zip(owner[at[rows[hit]]].tolist(), (place[at[rows[hit]]] - shift[hit]).tolist()):
        flags[c][begin] = True
    return flags


class Bytes:
    """Strings are judged as bytes."""

    length = LENGTH
    find_spots = staticmethod(find_spots)
    repeated = staticmethod(repeated_strings)
    #: Bytes that a unit takes in a context.
    width = 1

    @staticmethod
    def units(text: bytes) -> bytes:
        return text

    @staticmethod
    def cut(units: bytes, a: int, b: int) -> bytes:
        return units[a:b]

    @staticmethod
    def places(text: bytes, ranges: list[int], length: int) -> list[tuple[int, int]]:
        """Begin and end, in bytes, of what the strings cover."""
        return [(a, b + length) for a, b in zip(ranges[::2], ranges[1::2])]


def _sort_groups(length: int, unit=Bytes):
    schema = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("ranges", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "anchor", 6 << 20):
            contexts = [x.as_py() for x in table.column("bytes")]
            flags = unit.repeated(contexts, table.column("p").to_pylist(), length)
            found = [(i, _ranges(f)) for i, f in enumerate(flags) if f.any()]
            if found:
                take = pa.array([i for i, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [table.column("anchor").take(take).combine_chunks(), table.column("context").take(take).combine_chunks(), pa.array([x for _, x in found], pa.list_(pa.int64()))], schema=schema
                )

    return run


def _each_string(length: int, unit=Bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, context, data, p in zip(*[batch.column(c).to_pylist() for c in ("anchor", "context", "bytes", "p")]):
                size = unit.width
                n = len(data) // size - length + 1
                strings = [xxhash.xxh3_128_digest(data[i * size : (i + length) * size], seed=p - i + length) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * n), pa.array([context] * n), pa.array(range(n), pa.int64()), pa.array(strings, pa.binary())], names=["anchor", "context", "at", "string"])

    return run


def repeated_ranges(own: DataFrame, length: int = LENGTH, most_contexts: int = MOST_CONTEXTS, unit=Bytes) -> DataFrame:
    """``_id``, ``_h`` and ``ranges``: first and last starts of the repeated strings of a document, one pair after the other."""
    found = materialize(unit.find_spots(own, length), "spots")
    # stored, so that the spots of a hot anchor, which periodic texts have, are only joined and can be split among tasks
    several = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
    found = materialize(found.join(several, "anchor", "left_semi"), "spots-shared")
    contexts = found.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_h", "a", "b", "p")).alias("rep"))
    contexts = materialize(contexts, "contexts")
    kinds = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    mixed = contexts.join(kinds, "anchor").select("anchor", "context", "kinds", "rep.*")
    asked = mixed.groupBy("_id", "_h").agg(F.collect_list(F.struct("anchor", "context", "kinds", "a", "b", "p")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("kinds", pa.int64()), ("p", pa.int64()), ("bytes", pa.binary())])

        def rows():
            for batch in batches:
                for text, spots_ in zip(batch.column("_text").cast(pa.binary()), batch.column("asked")):
                    data = unit.units(text.as_py())
                    for x in spots_.as_py():
                        yield x["anchor"], x["context"], x["kinds"], x["p"] - x["a"], unit.cut(data, x["a"], x["b"] + length)

        yield from batches_of(rows(), schema, 2000)

    bytes_ = join_text(own.select("_id", "_h", "_text"), asked, "inner").select("_text", "asked")
    bytes_ = bytes_.mapInArrow(cut, "anchor long, context long, kinds long, p long, bytes binary")
    columns = "anchor long, context long, ranges array<bigint>"
    few = bytes_.filter(F.col("kinds") <= most_contexts).select("anchor", "context", "p", "bytes")
    few = few.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(_first_of_each(_sort_groups(length, unit)), columns)
    whole = contexts.filter("n > 1").select("anchor", "context", F.array(F.lit(0).cast("long"), F.col("rep.b") - F.col("rep.a")).alias("ranges"))
    ranges = whole.unionByName(materialize(few, "contexts-sorted").join(whole.select("anchor", "context"), ["anchor", "context"], "left_anti"))
    if kinds.filter(F.col("kinds") > most_contexts).limit(1).count():
        strings = bytes_.filter(F.col("kinds") > most_contexts).select("anchor", "context", "p", "bytes").mapInArrow(_each_string(length, unit), "anchor long, context long, at long, string binary")
        strings = materialize(strings.distinct(), "strings")
        twice = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        hit = strings.join(twice, ["anchor", "string"], "left_semi").join(whole.select("anchor", "context"), ["anchor", "context"], "left_anti")
        pairs = hit.groupBy("anchor", "context").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("ranges"))
        ranges = ranges.unionByName(pairs)
    back = found.join(ranges, ["anchor", "context"]).select("_id", "_h", F.transform("ranges", lambda x: x + F.col("a")).alias("ranges"))
    return back.groupBy("_id", "_h").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _first_of_each(inner):
    """Drops rows that repeat the context before them (from rows that are equal in id and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unique():
            last = None
            for batch in batches:
                keys = list(zip(batch.column("anchor").to_pylist(), batch.column("context").to_pylist()))
                keep = [k != (keys[i - 1] if i else last) for i, k in enumerate(keys)]
                last = keys[-1] if keys else last
                yield batch if all(keep) else batch.filter(pa.array(keep))

        yield from inner(unique())

    return run


def remove_ranges(data: bytes, ranges: list[int], length: int = LENGTH, unit=Bytes) -> tuple[bytes, int, int]:
    """The bytes left, how many were removed, and in how many stretches."""
    parts, removed, stretches, end = [], 0, 0, 0
    for a, stop in sorted(unit.places(data, ranges, length)):
        if not stretches or a > end:
            parts.append(data[end:a])
            removed += stop - a
            stretches += 1
            end = stop
        elif stop > end:
            removed += stop - end
            end = stop
    parts.append(data[end:])
    return b"".join(parts), removed, stretches


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, length: int | None = None, most_contexts: int = MOST_CONTEXTS, unit=Bytes
) -> DataFrame:
    """Per row: ``id``, the columns of ``keep`` as a struct, ``text`` and ``kept_sha256`` of what is left, ``n_bytes``, ``n_removed``, ``n_spans``.

    ``unit`` and ``length``: strings of so many bytes (``Bytes``) or words (``word_passages.Words``).
    """
    length = length or unit.length
    own = keyed(docs, id_col, text_col, keep)
    passed = {"_id": "id", "_keep": "keep"} if keep else {"_id": "id"}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, digest, size, gone, spans = [], [], [], [], []
            for text, ranges in zip(batch.column("_text").cast(pa.binary()), batch.column("ranges")):
                data = text.as_py()
                kept, removed, stretches = remove_ranges(data, ranges.as_py() or [], length, unit)
                left.append(kept.decode("utf-8", "ignore"))
                digest.append(hashlib.sha256(kept).hexdigest())
                size.append(len(data))
                gone.append(removed)
                spans.append(stretches)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(left, pa.string()), pa.array(digest, pa.string()), *[pa.array(x, pa.int64()) for x in (size, gone, spans)]],
                names=[*passed.values(), "text", "kept_sha256", "n_bytes", "n_removed", "n_spans"],
            )

    joined = join_text(own, repeated_ranges(own, length, most_contexts, unit)).select(*passed, "_text", "ranges")
    return joined.mapInArrow(cut, schema_with(own, passed, "text string, kept_sha256 string, n_bytes long, n_removed long, n_spans long"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup(read(spark, folder, "documents", "doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLES: dict[str, str] = {}
