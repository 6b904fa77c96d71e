"""Byte-level BPE.

The ranks are a map in the plan: a literal perfect hash table, found by two array accesses. A word starts as the array of its bytes, and
each step of a fold over it, in Spark's higher-order functions, merges the leftmost pair of lowest rank, until no pair has a rank. Bytes are written
as two hex digits, so that joining pieces is joining strings.

Folded that way are the distinct words: the commonest of the corpus (at most ``WORDS``, each of at most ``WORD_BYTES`` bytes), counted over all texts. Their ids
are broadcast, and texts are encoded by Arrow batches. Rarer words are merged there by the same rule, some megabytes' words at a time: each step merges one pair in every
word (``PairTable``). Words above ``WORD_BYTES`` go through a heap, so a word of any length costs no more than n log n. Which words are common changes the
speed only. Decoding concatenates the pieces of the ids.

Texts are cut at blanks first, where no match of the pattern is divided, as such parts repeat: most are words, without the pattern. Arrow cuts and
numbers them, so a distinct part of some megabytes of text is looked at once.

Texts are not encoded inside the plan, too, because a lookup in interpreted lambda functions takes microseconds: see the README.

Defined results: null and empty texts have no tokens; strings of special tokens are ordinary text; rows are encoded one by one, whatever their ids.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import let, materialize, read, schema_with

RANKS = "byte_bpe_50k.tiktoken"
WORDS, WORD_BYTES = 1 << 17, 40
#: What ``regex`` takes for a blank.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f"[{_BLANK}]?[^{_BLANK}]+|[{_BLANK}]+(?=[{_BLANK}][^{_BLANK}])|[{_BLANK}]+").findall
#: The tokenizers' pattern on ASCII.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+").findall
#: A space with a blank or nothing behind it, for Arrow.
_CROWDED = r" ([\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"
_LETTERS = r"\A ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+\z"
SEPARATOR = "\x1f"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def literal_strings(values: list[str]) -> Column:
    """An array literal: one string that the optimizer splits once."""
    return F.split(F.lit(SEPARATOR.join(values)), SEPARATOR)


def literal_ints(values) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


class LiteralMap:
    """A perfect hash table from strings to positions, as array literals.

    A key's hash names a bucket; the bucket's number, mixed in by exclusive or, leads each of its keys to a slot of its own.
    """

    def __init__(self, keys: list[str]):
        hashes = [xxhash.xxh64_intdigest(k.encode(), seed=42) for k in keys]
        self.bits = max(4, (max(len(keys), 1) - 1).bit_length() + 1)
        while not self._place(keys, hashes):
            self.bits += 1

    def _place(self, keys: list[str], hashes: list[int]) -> bool:
        slots, buckets = 1 << self.bits, 1 << max(self.bits - 3, 1)
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            members.setdefault(h & (buckets - 1), []).append(i)
        taken = np.full(slots, -1, np.int64)
        shift = np.zeros(buckets, np.int64)
        rng = np.random.default_rng(1)
        for b in sorted(members, key=lambda b: -len(members[b])):
            own = [(hashes[i] >> 20) & (slots - 1) for i in members[b]]
            if len(set(own)) < len(own):
                return False
            for _ in range(4000):
                s = int(rng.integers(slots))
                at = [o ^ s for o in own]
                if (taken[at] < 0).all():
                    taken[at] = members[b]
                    shift[b] = s
                    break
            else:
                return False
        self.order, self.buckets, self.slots = taken, buckets, slots
        self.keys = literal_strings([keys[i] if i >= 0 else "" for i in taken.tolist()])
        self.shift = literal_ints(shift.tolist())
        return True

    def values(self, values: list) -> list:
        """Values in the order of the slots; 0 where there is none."""
        return [values[i] if i >= 0 else 0 for i in self.order.tolist()]

    def slot(self, key: Column, then) -> Column:
        """``then(slot)`` if the key is there, else null."""

        def probe(h: Column) -> Column:
            bucket = h.bitwiseAND(F.lit(self.buckets - 1)).cast("int")
            place = F.shiftright(h, 20).bitwiseAND(F.lit(self.slots - 1)).cast("int").bitwiseXOR(F.get(self.shift, bucket))
            return let(place, lambda s: F.when(F.get(self.keys, s) == key, then(s)))

        return let(F.xxhash64(key), probe)


class Bpe:
    """The folding column for one set of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.map = LiteralMap([t.hex() for t in tokens])
        self.rank = literal_ints(self.map.values([ranks[t] for t in tokens]))

    def rank_of(self, piece: Column) -> Column:
        return self.map.slot(piece, lambda s: F.get(self.rank, s))

    def fold(self, word: Column) -> Column:
        """Ids of one word, from its bytes, by merges of the lowest rank."""

        def merge(state: Column, _: Column) -> Column:
            def lowest(p: Column, ranks: Column) -> Column:
                def join(k: Column) -> Column:
                    joined = F.concat(F.get(p, k - 1), F.get(p, k))
                    left = F.concat(F.slice(p, 1, k - 1), F.array(joined), F.slice(p, k + 2, F.size(p)))
                    return F.struct(left.alias("p"), (F.size(p) <= 2).alias("done"))

                least = F.array_min(ranks)
                return let(
                    F.coalesce(F.array_position(ranks, least), F.lit(0)).cast("int"),
                    lambda k: F.when(k > 0, join(k)).otherwise(F.struct(p.alias("p"), F.lit(True).alias("done"))),
                )

            pairs = F.transform(F.sequence(F.lit(1), F.size(state["p"]) - 1), lambda i: self.rank_of(F.concat(F.get(state["p"], i - 1), F.get(state["p"], i))))
            return F.when(state["done"], state).otherwise(let(pairs, lambda r: lowest(state["p"], r)))

        def start(h: Column) -> Column:
            n = (F.length(h) / 2).cast("int")
            bytes_ = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(h, i * 2 + 1, F.lit(2)))
            first = F.struct(bytes_.alias("p"), (n <= 1).alias("done"))
            merged = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), first, merge)
            return F.transform(merged["p"], lambda x: self.rank_of(x))

        return let(F.lower(F.hex(F.encode(word, "utf-8"))), lambda h: self._whole(h, start))

    def _whole(self, h: Column, start) -> Column:
        """A word that is a token is that token."""
        return let(self.rank_of(h), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(start(h)))


def units_of(pattern: str):
    """Cuts a text into parts in which the pattern's matches are those in the text.

    The tokenizers' pattern has a match begin at the last of several blanks before a word, and at a single blank; no match goes beyond. So a text is cut
    there, into words with the blank before them and what is left of runs of blanks, of which most come again. Other patterns are given whole texts.
    """
    import public_tokenizers

    return _UNITS if pattern == public_tokenizers.PATTERN else lambda text: [text]


def words_of(pattern: str):
    """Finds the pattern's matches in such a part. A part of ASCII goes through Python's ``re``, whose classes are those of ``regex`` there."""
    import public_tokenizers

    find = regex.compile(pattern).findall
    return (lambda part: _ASCII_WORDS(part) if part.isascii() else find(part)) if pattern == public_tokenizers.PATTERN else find


def single(parts, pattern: str):
    """Which parts are surely one match: letters that every version of Unicode takes for letters, with a space before them or not."""
    import public_tokenizers

    return pc.match_substring_regex(parts, _LETTERS if pattern == public_tokenizers.PATTERN else r"\z\A.")


def cut(texts: pa.Array, pattern: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Parts of all texts in order (see ``units_of``), and how many each text has.

    A part may hold several units: a cut before a blank with a word behind it does as well. So a text in which every space is such a one is
    split at its spaces by Arrow.
    """
    import public_tokenizers

    units = units_of(pattern)
    crowded = np.ones(len(texts), bool)
    if pattern == public_tokenizers.PATTERN:
        crowded = pc.match_substring_regex(texts, _CROWDED).to_numpy(zero_copy_only=False)
    held, counts = [], []
    # stretches of texts of one kind
    edges = np.flatnonzero(np.diff(crowded)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(texts)]):
        if a == b:
            continue
        own = texts.slice(a, b - a)
        if crowded[a]:
            found = [units(t) for t in own.to_pylist()]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            held.append(pa.array(list(chain.from_iterable(found)), pa.string()))
        else:
            lists = pc.split_pattern(own, " ")
            words = lists.flatten()
            counts.append(pc.list_value_length(lists).to_numpy().astype(np.int64))
            first = np.zeros(len(words), bool)
            first[np.cumsum(counts[-1]) - counts[-1]] = True
            held.append(pc.binary_join_element_wise(pc.if_else(pa.array(first), "", " "), words, ""))
    return pa.concat_arrays([*held, pa.array([], pa.string())]).dictionary_encode(), np.concatenate([np.empty(0, np.int64), *counts])


def count_words(texts: DataFrame, pattern: str) -> DataFrame:
    """``word`` and ``n`` of the pattern's matches in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = words_of(pattern), pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})

        def summed(parts: pa.Table) -> pa.Table:
            return parts.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def flush(parts: pa.Table) -> Iterator[pa.RecordBatch]:
            whole = single(parts.column("word"), pattern)
            yield from parts.filter(whole).to_batches()
            rest, words = parts.filter(pc.invert(whole)), Counter()
            for part, n in zip(rest.column("word").to_pylist(), rest.column("n").to_pylist()):
                for word in find(part):
                    words[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for texts in slices(batch.column("text")):
                parts = cut(texts, pattern)[0]
                n = pa.array(np.bincount(parts.indices.to_numpy(), minlength=len(parts.dictionary)).astype(np.int64))
                held = pa.concat_tables([held, pa.table({"word": parts.dictionary, "n": n})])
                if len(held) > 400_000:
                    held = summed(held)
                    if len(held) > 300_000:
                        yield from flush(held)
                        held = held.slice(0, 0)
        if len(held):
            yield from flush(summed(held))

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(bpe: Bpe, texts: DataFrame, most: int = WORDS) -> tuple[list[str], list[list[int]]]:
    """The commonest distinct words of all texts with their ids, folded by column functions; at most ``most`` of at most ``WORD_BYTES`` bytes."""
    words = count_words(texts, bpe.pattern)
    fitting = words.filter((F.col("n") > 1) & (F.octet_length("word") <= WORD_BYTES))
    top = materialize(fitting.orderBy(F.col("n").desc(), "word").limit(most).select("word"), "bpe-words")
    tasks = texts.sparkSession.sparkContext.defaultParallelism
    table = top.repartition(tasks, "word").select("word", bpe.fold(F.col("word")).alias("ids")).toArrow()
    return table.column("word").to_pylist(), table.column("ids").to_pylist()


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the leftmost pair of lowest rank is merged until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= WORD_BYTES:
        return _merge_short(word, ranks)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two was merged meanwhile
        parts[i] += parts[j]
        parts[j] = None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n:
                joined = parts[left] + parts[right]
                rank = ranks.get(joined)
                if rank is not None:
                    heapq.heappush(heap, (rank, left, len(joined)))
    return [ranks[x] for x in parts if x is not None]


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a few bytes: all pairs are looked over at each merge."""
    get, none = ranks.get, 1 << 60
    at = list(range(len(word) + 1))  # where parts begin
    pairs = [get(word[i : i + 2], none) for i in at[:-2]]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        del at[i + 1], pairs[i]
        if i:
            pairs[i - 1] = get(word[at[i - 1] : at[i + 1]], none)
        if i < len(pairs):
            pairs[i] = get(word[at[i] : at[i + 2]], none)
    return [ranks[word[i:j]] for i, j in zip(at, at[1:])]


class PairTable:
    """Ranks of two tokens joined, for many pairs at once, and merges of many words by them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = self.base = max(ranks.values()) + 1
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        bits = max(len(pairs), 1).bit_length() + 2
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, self.none, np.int64)
        keys, found = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a slot, one stays
            own = self.keys[at] == keys
            self.ranks[at[own]] = found[own]
            keys, found, at = keys[~own], found[~own], (at[~own] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``none`` where there is none."""
        keys = left * self.base + right
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], self.none)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.last
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's begin and how many there are; ``data``: the bytes of words, none empty, of those sizes.

        In each word the leftmost pair of lowest rank is merged until none has a rank.
        """
        tokens, word = self.bytes[data], np.arange(len(sizes))
        ids, order, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        pairs = self._pairs(tokens, sizes)
        while len(word):
            starts = np.cumsum(sizes) - sizes
            # leftmost of the lowest
            least = np.minimum.reduceat(pairs * (1 << 32) + np.arange(len(pairs)), starts)
            rank, at = least >> 32, least & ((1 << 32) - 1)
            done = rank == self.none
            keep = np.repeat(~done, sizes)
            ids.append(tokens[~keep])
            order.append(word[done])
            counts.append(sizes[done])
            tokens[at[~done]] = rank[~done]
            keep[at[~done] + 1] = False
            place = np.cumsum(keep) - 1  # where a token goes
            tokens, pairs = tokens[keep], pairs[keep]
            word, sizes, at = word[~done], sizes[~done] - 1, place[at[~done]]
            ends = np.cumsum(sizes)
            right = at + 1 < ends
            pairs[at] = self.none
            pairs[at[right]] = self.rank(tokens[at[right]], tokens[at[right] + 1])
            left = at[at > ends - sizes]
            pairs[left - 1] = self.rank(tokens[left - 1], tokens[left])
        order, counts = np.concatenate(order), np.concatenate(counts)
        back = np.argsort(order)
        return np.concatenate(ids), (np.cumsum(counts) - counts)[back], counts[back]

    def _pairs(self, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The rank of each token with the next one of its word."""
        pairs = np.full(len(tokens), self.none, np.int64)
        if len(tokens):
            pairs[:-1] = self.rank(tokens[:-1], tokens[1:])
            pairs[np.cumsum(sizes) - 1] = self.none
        return pairs


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``starts``, one behind the other."""
    out = [values[:0]]
    for a in range(0, len(starts), 1 << 18):
        n = sizes[a : a + (1 << 18)]
        ends = np.cumsum(n)
        out.append(values[np.repeat(starts[a : a + (1 << 18)] - (ends - n), n) + np.arange(ends[-1])])
    return np.concatenate(out)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values from their bytes."""
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch above 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _offsets(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class Pieces:
    """The bytes of ids, one piece behind the other."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.all = np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """One binary value for every text; ``counts``: how many of the ids are its own."""
        sizes = self.sizes[ids]
        return binary_array(gather(self.all, self.starts[ids], sizes), _offsets(sizes)[_offsets(counts)])


class _Encoder:
    """Ids of texts: distinct words are looked up, and those not known are merged together."""

    def __init__(self, known: dict[str, bytes], ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.find, self.pairs = ranks, pattern, words_of(pattern), PairTable(ranks)
        self.words = pa.array([*(w.encode() for w in known), *ranks], pa.binary())  # a word that is a token is that token
        self.sizes = np.array([*(len(i) // 4 for i in known.values()), *[1] * len(ranks)], np.int64)
        self.ids = np.concatenate([np.frombuffer(b"".join(known.values()), "<u4"), np.array(list(ranks.values()), "<u4")])

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's begin and how many there are."""
        words = words.cast(pa.binary())
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        starts, sizes = (np.cumsum(self.sizes) - self.sizes)[at], np.where(at < 0, 0, self.sizes[at])
        length = pc.binary_length(words).to_numpy()
        short, long = (np.flatnonzero((at < 0) & (length > 0) & ((length <= WORD_BYTES) == x)) for x in (True, False))
        rare = words.take(pa.array(short))
        ids = [self.ids]
        merged, begin, n = self.pairs.merge(np.frombuffer(b"".join(rare.to_pylist()), np.uint8), length[short].astype(np.int64))
        ids.append(merged.astype("<u4"))
        starts[short], sizes[short] = begin + len(self.ids), n
        end = len(self.ids) + len(merged)
        for i in long.tolist():
            ids.append(np.array(merge_word(words[i].as_py(), self.ranks), "<u4"))
            starts[i], sizes[i] = end, len(ids[-1])
            end += len(ids[-1])
        return np.concatenate(ids), starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        parts, counts = cut(texts, self.pattern)
        index = parts.indices.to_numpy()
        whole = single(parts.dictionary, self.pattern)
        found, n = [], []
        for part in parts.dictionary.filter(pc.invert(whole)).to_pylist():
            words = self.find(part)
            found += words
            n.append(len(words))
        words = pa.concat_arrays([parts.dictionary.filter(whole), pa.array(found, pa.string())]).dictionary_encode()
        # words of each part: whole ones come first
        whole = whole.to_numpy(zero_copy_only=False)
        of_part = np.ones(len(whole), np.int64)
        of_part[~whole] = n
        first = np.empty(len(whole), np.int64)
        first[whole], first[~whole] = np.arange(whole.sum()), whole.sum() + _offsets(n)[:-1]
        ids, starts, sizes = self._look_up(words.dictionary)
        word = gather(words.indices.to_numpy(), first[index], of_part[index])
        before = _offsets(sizes[word])[_offsets(of_part[index])]
        return gather(ids, starts[word], sizes[word]), np.diff(before[_offsets(counts)])


def slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """The texts in stretches of some megabytes."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most)) + 1
        yield texts.slice(start, end - start)
        start = end


def encode(texts: DataFrame, path: str, pattern: str | None = None, most_words: int = WORDS, decoded: bool = False) -> DataFrame:
    """Adds ``ids``, the packed token ids (little-endian unsigned 32-bit), to a table with the column ``text`` (no nulls).

    With ``decoded``, the ids are decoded again in the same pass, part by part (see ``units_of``), into the column ``decoded``.
    """
    import public_tokenizers

    pattern = pattern or public_tokenizers.PATTERN
    ranks = load_ranks(path)
    words, ids = common_words(Bpe(ranks, pattern), texts, most_words)
    # at most most_words * (WORD_BYTES + 4 * WORD_BYTES) bytes
    known = texts.sparkSession.sparkContext.broadcast({w: np.array(i, "<u4").tobytes() for w, i in zip(words, ids)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        pieces, encoder = Pieces(ranks), _Encoder(known.value, ranks, pattern)
        for batch in batches:
            done = 0
            for part in slices(batch.column("text")):
                ids, counts = encoder.encode(part)
                out = batch.slice(done, len(part)).append_column("ids", binary_array(ids, 4 * _offsets(counts)))
                yield out.append_column("decoded", pieces.join(ids, counts)) if decoded else out
                done += len(part)

    more = "ids binary, decoded binary" if decoded else "ids binary"
    return texts.mapInArrow(run, schema_with(texts, {c: c for c in texts.columns}, more))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the bytes of the pieces of ``ids`` one behind the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(load_ranks(path))
        for batch in batches:
            ids = [i.as_py() for i in batch.column("ids")]
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            yield batch.append_column("decoded", pieces.join(np.frombuffer(b"".join(ids), "<u4"), counts))

    return encoded.mapInArrow(run, schema_with(encoded, {c: c for c in encoded.columns}, "decoded binary"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(RANKS)
    docs = read(spark, folder, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    out = encode(docs, path, decoded=True)
    n = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLES: dict[str, str] = {}
