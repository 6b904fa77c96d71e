"""Packs tokenised documents into sequences by column generation for the cutting-stock problem.

Documents are tokenised once and cut into pieces of a whole sequence and one rest. Pieces are counted by size class (``UNIT`` tokens), a histogram
of ``size / UNIT`` numbers whatever the corpus. On it a linear program finds how often to use which pattern of classes: starting
with patterns of one class, the duals price the classes, an unbounded knapsack (dynamic programming over the sequence) finds the
pattern of most value, which enters the basis, until none is worth more than a sequence. The solution is rounded down, and the few pieces left
over are packed first fit, largest first. Then pieces are ranked within their class, by cells, and a rank's place in the class's list of patterns
tells its sequence. No piece is moved but by its rank, and only slim rows are shuffled.

Every sequence holds at most ``size`` tokens. Defined results: a null text is empty, and its piece is the closing token alone; rows that are equal are packed
one by one; a text of any length is cut into as many pieces as it needs; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.ordered import number_rows
from .kit import batches_of, keyed, materialize, read

SIZE, UNIT, CLOSE = 1024, 4, 0
TOKENIZER = "byte_bpe_50k.json"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable in Latin-1, else the next free code from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoding(path: str, added: bool = False):
    """The byte-level BPE of a tokenizers file, as an encoder that releases ids as arrays; its ids are those of the tokenizers library.

    ``added``: the file's added tokens are found in texts, as the library does unless told to ``encode_special_tokens``.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    vocab, extra = stored["model"]["vocab"], {t["content"]: t["id"] for t in stored["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token)}
    for token in extra:
        ranks.pop(token.encode(), None)
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=extra if added else {})


def cut_documents(docs: DataFrame, path: str, size: int = SIZE, close: int = CLOSE, added: bool = False) -> DataFrame:
    """One row per piece: ``_id``, ``_h``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``."""
    id_type = docs.schema["_id"].dataType.simpleString()
    schema = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path, added)
        for batch in batches:

            def rows(batch=batch):
                for i, text in enumerate(batch.column("_text")):
                    ids = np.append(np.asarray(encoding.encode_to_numpy(text.as_py(), allowed_special="all", disallowed_special=()), np.uint32), np.uint32(close)).astype("<u4")
                    n = len(ids)
                    for start in range(0, n, size):
                        piece = ids[start : start + size]
                        yield i, start, len(piece), zlib.crc32(piece.tobytes()), n

            for out in batches_of(rows(), schema, 10_000):
                take = out.column("row")
                yield pa.RecordBatch.from_arrays([batch.column("_id").take(take), batch.column("_h").take(take), *out.columns[1:]], names=["_id", "_h", *schema.names[1:]])

    return docs.mapInArrow(run, f"_id {id_type}, _h long, start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of (sorted) sizes within ``room`` of most value: unbounded knapsack by dynamic programming."""
    best, last = np.zeros(room + 1), [-1] * (room + 1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), "right").tolist()
    for c in range(int(sizes[0]), room + 1):
        k = fitting[c]
        gain = best[c - sizes[:k]] + value[:k]
        i = int(gain.argmax())
        if gain[i] > best[c - 1] + 1e-12:
            best[c], last[c] = gain[i], i
        else:
            best[c] = best[c - 1]
    pattern = np.zeros(len(sizes), np.int64)
    c = room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[room]), pattern


def first_basis(sizes: np.ndarray, need: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of one class each, but classes that fill a sequence together are paired as often as both are there; and their inverse."""
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    at = {int(c): i for i, c in enumerate(sizes)}
    for i, c in enumerate(sizes.tolist()):
        j = at.get(room - c)
        if j is not None and i < j:
            rare, other = (i, j) if need[i] <= need[j] else (j, i)
            basis[:, rare] = 0
            basis[[i, j], rare] = 1
            inverse[rare, rare] = 1
            inverse[other, rare] = -inverse[other, other]
    return basis, inverse


def _times(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """A small product, kept off the many threads of a linear algebra library."""
    return (matrix * column).sum(axis=1)


def solve_patterns(sizes: np.ndarray, need: np.ndarray, room: int, gap: float = 0.0005, most_rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, by column generation to within ``gap`` of the linear program's bound."""
    basis, inverse = first_basis(sizes, need, room)
    x = _times(inverse, need)
    least = float((sizes * need).sum()) / room
    for _ in range(most_rounds):
        value = inverse.sum(axis=0)  # duals of one sequence per pattern
        worth, pattern = best_pattern(np.maximum(value, 0), sizes, room)
        least = max(least, float((np.maximum(value, 0) * need).sum()) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or x.sum() <= least * (1 + gap):
            break
        step = _times(inverse, pattern)
        up = step > 1e-9
        ratio = np.where(up, x / np.where(up, step, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        x = np.maximum(_times(inverse, need), 0)
    return np.rint(basis).astype(np.int64), x


def plan_sequences(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern by class, times used) that together hold every piece exactly once."""
    plan = [({room: 1}, histogram[room])] if histogram.get(room) else []
    sizes = np.array(sorted(c for c, n in histogram.items() if c < room and n), np.int64)
    if not len(sizes):
        return plan
    need = np.array([histogram[c] for c in sizes.tolist()], np.int64)
    patterns, used = solve_patterns(sizes, need.astype(float), room)
    left = need.copy()
    for p, x in zip(patterns.T, used):
        inside = p > 0
        times = min(math.floor(x + 1e-6), int((left[inside] // p[inside]).min())) if inside.any() else 0
        if times > 0:
            left -= p * times
            plan.append(({int(sizes[i]): int(p[i]) for i in np.flatnonzero(inside)}, times))
    bins: list[list] = []  # the rounded-off rest: first fit, largest first
    for i in range(len(sizes) - 1, -1, -1):
        c, n = int(sizes[i]), int(left[i])
        for b in bins:
            fit = min(n, b[0] // c)
            if fit:
                b[0] -= fit * c
                b[1][c] = b[1].get(c, 0) + fit
                n -= fit
        while n:
            fit = min(n, room // c)
            bins.append([room - fit * c, {c: fit}])
            n -= fit
    return plan + [(b[1], 1) for b in bins]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, unit: int = UNIT, close: int = CLOSE, added: bool = False) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    pieces = materialize(cut_documents(keyed(docs, id_col, text_col), path, size, close, added), "pieces")
    pieces = pieces.withColumn("cls", F.ceil(F.col("length") / F.lit(unit)).cast("int"))
    histogram = {r["cls"]: r["n"] for r in pieces.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most size / unit rows
    plan = plan_sequences(histogram, size // unit)
    ranges: dict[int, list[tuple[int, int, int]]] = {}  # class: first rank, pieces in each sequence, first sequence
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for c, per in pattern.items():
            ranges.setdefault(c, []).append((taken.get(c, 0), per, sequence))
            taken[c] = taken.get(c, 0) + per * times
        sequence += times
    table = {c: np.array(v, np.int64) for c, v in ranges.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, rank = batch.column("cls").to_numpy(), batch.column("rank").to_numpy() - 1
            found = np.zeros(len(cls), np.int64)
            for c in np.unique(cls).tolist():
                own = cls == c
                first, per, base = table[c][np.searchsorted(table[c][:, 0], rank[own], "right") - 1].T
                found[own] = base + (rank[own] - first) // per
            yield batch.append_column("sequence_id", pa.array(found))

    bits = max(0, math.ceil(math.log2(max(histogram.values(), default=1) / 100_000 + 1)))
    cell = F.pmod(F.xxhash64("_id", "_h", "start"), F.lit(1 << bits))
    ranked = number_rows(pieces.withColumn("cell", cell), ["cls"], ["cell"], [F.col("_id"), F.col("_h"), F.col("start")])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    dealt = ranked.mapInArrow(assign, f"{fields}, sequence_id long")
    w = W.partitionBy("sequence_id").orderBy(F.col("cls").desc(), "rank").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long").alias("offset")
    return dealt.select(F.col("_id").alias("id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    out = pack(read(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER), added=True)
    return out.withColumnRenamed("id", "doc_id")


QUERIES = {"op7_packing": op7_packing}
ORACLES: dict[str, str] = {}
