"""Exact Jaccard self-join of documents by their word shingles, through prefix trees.

1. Every document becomes its set of distinct 5-word shingles, 64-bit hashes. Documents with equal sets are one class.
2. All sets are ordered alike: shingles by hash, then the commonest ones (a bounded list, counted over all documents) by their count.
   The first ``l`` shingles that two sets of a similarity of t share are among the first ``n - ceil(t n) + l`` of each; ``l`` is a share of n. Common
   shingles come last, so passages that many documents share rarely bring documents together.
3. Every shingle of those prefixes that several classes of near sizes have names a leader among them; a class belongs to
   the groups of its shingles' leaders. A class of which fewer than ``l`` shingles are found elsewhere is similar to none. Two similar classes share a
   group, and each class is sent to each of its groups once. Common shingles' leaders come from partial minima, so a hot shingle is never gathered.
4. Within a group, sets are put one by one into a prefix tree, commonest shingles first. Before that, each walks the tree: classes
   below a node share the overlap counted so far, and a subtree is left when that overlap and what remains on either side can't reach the
   similarity, or when all of it is already connected with the set that walks.
5. A group of more shingles than fit a task is dealt over blocks, each with the leader. Blocks whose classes all end up in the leader's component
   are done; the classes left over, and only these, then meet all blocks.
6. Links become components by alternating stars.

Which classes a group has, how it is cut and which shingles count as common changes the speed only, not the links. Hashes stand for shingles and classes.

Defined results: null, empty or blank texts have empty sets and are linked with nothing; texts of fewer than five words are one shingle; rows with
equal texts are linked; null ids are left out of the smallest id, which is null if a component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .kit import batches_of, join_text, keyed, materialize, read, sorted_groups

WORDS, PERCENT = 5, 80
#: Most shingles that count as common, and how often a block of texts must have one to report it.
COMMON, REPORT = 1 << 17, 4
#: Of every so many shingles of a set, one more is asked to be shared.
SHARE = 12
#: Shingles that a task holds of one group.
BLOCK_SHINGLES = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    found = text.translate(_LOWER).split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, found), np.uint64, n)
    size = min(words, n)
    h = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        h = h * _P + own[k : n - size + 1 + k]
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return np.unique(h)


def prefix(own: np.ndarray, common: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set in the order of all sets: so many that each similar set has ``n // SHARE + 1`` of them, or as many as
    its own size asks for, in its own prefix."""
    n = len(own)
    take = n - (percent * n + 99) // 100 + n // SHARE + 1
    if not n or not len(common):
        return own[:take]
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    is_common = common[at] == own
    rare = own[~is_common]
    if len(rare) >= take:
        return rare[:take]
    late = own[is_common][np.argsort(rank[at[is_common]], kind="stable")]
    return np.concatenate([rare, late])[:take]


def common_shingles(docs: DataFrame, words: int, most: int = COMMON, report: int = REPORT) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles, sorted by hash, and their ranks by rising count: ``most`` at the most, whatever the size of the corpus."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= report
            return pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(n[many].astype(np.int64))], schema=schema)

        for batch in batches:
            for text in batch.column("_text").cast(pa.binary()):
                own = shingles(text.as_py(), hashes, words)
                held.append(own)
                size += len(own)
                if size > 3_000_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counted = docs.select("_text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.col("n").desc(), "token").limit(most).toArrow()
    token = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], (len(token) - np.arange(len(token)))[order]


class _Node:
    __slots__ = ("seg", "kids", "sets", "least", "rest", "one")

    def __init__(self, seg, least, rest):
        self.seg, self.kids, self.sets = seg, {}, []
        self.least, self.rest = least, rest  # smallest set below, most shingles below
        self.one = True  # all sets below are known to be connected


class PrefixTree:
    """Sets in one global order, stored by shared beginnings; links every new set with the similar ones there."""

    def __init__(self, universe: int, percent: int):
        self.root = _Node(np.empty(0, np.int64), 1 << 60, 0)
        self.percent = percent
        self.sizes: list[int] = []
        self.parent: list[int] = []
        self.mark = np.zeros(universe, bool)
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def _any(self, node: _Node) -> int:
        while not node.sets:
            node = next(iter(node.kids.values()))
        return self.find(node.sets[0])

    def _connected(self, node: _Node, label: int) -> bool:
        """Whether all sets below are connected with ``label``; looks at the children only."""
        if node.one:
            return self._any(node) == label
        if all(self.find(s) == label for s in node.sets) and all(k.one and self._any(k) == label for k in node.kids.values()):
            node.one = True
            return True
        return False

    def add(self, own: np.ndarray, label: int | None = None, walk: bool = True, store: bool = True) -> int:
        """Walks the tree with a set of ranks (sorted), links it, then stores it. ``label``: a set it is known to be connected with."""
        me = len(self.sizes)
        n, p = len(own), self.percent
        self.sizes.append(n)
        self.parent.append(me if label is None else self.find(label))
        if walk:
            self.mark[own] = True
            todo = [(self.root, 0)]
            while todo:
                node, shared = todo.pop()
                mine = self.find(me)
                for kid in node.kids.values():
                    if self._connected(kid, mine):
                        continue
                    here = shared + int(np.count_nonzero(self.mark[kid.seg]))
                    left = n - int(np.searchsorted(own, kid.seg[-1], "right"))
                    if (100 + p) * (here + min(left, kid.rest)) < p * (n + kid.least):
                        continue
                    for other in kid.sets:
                        if (100 + p) * here >= p * (n + self.sizes[other]):
                            a, b = self.find(me), self.find(other)
                            if a != b:
                                self.links.append((me, other))
                                self.parent[a] = b
                                mine = b
                    if kid.kids:
                        todo.append((kid, here))
            self.mark[own] = False
        if store:
            self._store(own, me)
        return me

    def _store(self, own: np.ndarray, me: int) -> None:
        node, at, n, mine = self.root, 0, len(own), self.find(me)
        node.one = False
        while at < n:
            kid = node.kids.get(int(own[at]))
            if kid is None:
                kid = _Node(own[at:], n, 0)
                kid.sets.append(me)
                node.kids[int(own[at])] = kid
                return
            most = min(len(kid.seg), n - at)
            off = np.flatnonzero(kid.seg[:most] != own[at : at + most])
            same = int(off[0]) if len(off) else most
            if same < len(kid.seg):
                mid = _Node(kid.seg[:same], kid.least, kid.rest + len(kid.seg) - same)
                mid.one = kid.one
                kid.seg = kid.seg[same:]
                mid.kids[int(kid.seg[0])] = kid
                node.kids[int(own[at])] = mid
                kid = mid
            at += same
            kid.one = kid.one and self._any(kid) == mine
            kid.least, kid.rest = min(kid.least, n), max(kid.rest, n - at)
            node = kid
        node.sets.append(me)


def _ranked(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Sets as sorted ranks, commonest shingle of the group first."""
    token, inverse, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(token), np.int64)
    rank[np.lexsort((token, -n))] = np.arange(len(token))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(x) for x in np.split(rank[inverse], cuts)], len(token)


def link_group(nodes: list[int], sets: list[np.ndarray], percent: int, labels: list[int] | None = None, probe: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links that connect the similar sets of a group. With ``probe``, only pairs with a set marked there are looked for;
    sets of equal ``labels`` are connected already."""
    ranked, universe = _ranked(sets)
    tree = PrefixTree(universe, percent)
    seen: dict[int, int] = {}
    order = range(len(sets)) if probe is None else sorted(range(len(sets)), key=probe.__getitem__)
    where: list[int] = []
    for i in order:
        label = seen.get(labels[i]) if labels else None
        me = tree.add(ranked[i], label, walk=probe is None or probe[i])
        where.append(i)
        if labels and label is None:
            seen[labels[i]] = me
    return [(nodes[where[a]], nodes[where[b]]) for a, b in tree.links]


def _group_links(percent: int, words: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        unpack = zstandard.ZstdDecompressor().decompress

        def rows():
            for table in sorted_groups(batches, "grp", 3 << 20):
                keys = table.column("grp").to_numpy()
                cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
                nodes = table.column("node").to_numpy()
                texts = table.column("packed")
                labels, probe = table.column("label").to_numpy(), table.column("probe").to_numpy(zero_copy_only=False)
                for a, b in zip(cuts, cuts[1:]):
                    if b - a < 2:
                        continue
                    first = {}
                    for i in range(a, b):
                        first.setdefault(nodes[i], i)
                        if probe[i]:
                            first[nodes[i]] = i
                    at = list(first.values())
                    if len(at) < 2:
                        continue
                    sets = [shingles(unpack(texts[i].as_py()), hashes, words) for i in at]
                    only = [bool(probe[i]) for i in at]
                    known = [int(labels[i]) for i in at]
                    yield from link_group([int(nodes[i]) for i in at], sets, percent, known, None if all(only) else only)

        yield from batches_of(rows(), schema)

    return run


def _meet(sent: DataFrame, own: DataFrame, percent: int, words: int) -> DataFrame:
    """Links found in groups. ``sent``: node, representative (``_id``, ``_h``), ``grp``, ``label``, ``probe``."""
    per_doc = sent.groupBy("_id", "_h").agg(F.collect_list(F.struct("grp", "node", "label", "probe")).alias("to"))
    to = per_doc.schema["to"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [squeeze(t.as_py()) for t in batch.column("_text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("to")], names=["packed", "to"])

    # a text goes to several groups: it is packed once, tighter than shuffles do it
    texts = join_text(own, per_doc, "inner").select("_text", "to").mapInArrow(pack, f"packed binary, to {to}")
    texts = texts.select("packed", F.explode("to").alias("to")).select("to.grp", "to.node", "to.label", "to.probe", "packed")
    return texts.repartition("grp").sortWithinPartitions("grp").mapInArrow(_group_links(percent, words), "a long, b long")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block: int = BLOCK_SHINGLES
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``_h`` (hash of the text), ``n_shingles`` and ``component`` (smallest id reachable by links)."""
    spark = docs.sparkSession
    own = keyed(docs, id_col, text_col)
    common = spark.sparkContext.broadcast(common_shingles(own, words))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (token, rank) = WordHashes(), common.value
        for batch in batches:
            n, node, first = [], [], []
            for text in batch.column("_text").cast(pa.binary()):
                mine = shingles(text.as_py(), hashes, words)
                n.append(len(mine))
                node.append(xxhash.xxh3_64_intdigest(mine.tobytes(), seed=len(mine)) - (1 << 63))
                first.append(prefix(mine, token, rank, percent).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(first, pa.binary())], names=["_id", "_h", "n", "node", "prefix"]
            )

    id_type = own.schema["_id"].dataType.simpleString()
    known = materialize(own.mapInArrow(sets, f"_id {id_type}, _h long, n long, node long, prefix binary"), "shingle-sets")

    # leaders: the smallest class that has the shingle in its prefix
    def explode(want_common: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            token, _ = common.value
            for batch in batches:
                parts = [np.frombuffer(b.as_py(), np.uint64) for b in batch.column("prefix")]
                lengths = [len(p) for p in parts]
                if not sum(lengths):
                    continue
                tokens = np.concatenate(parts)
                node, n = (np.repeat(batch.column(c).to_numpy(), lengths) for c in ("node", "n"))
                if len(token):
                    is_common = token[np.minimum(np.searchsorted(token, tokens), len(token) - 1)] == tokens
                else:
                    is_common = np.zeros(len(tokens), bool)
                take = is_common if want_common else ~is_common
                yield pa.RecordBatch.from_arrays([pa.array(tokens[take].view(np.int64)), pa.array(node[take]), pa.array(n[take])], names=["token", "node", "n"])

        return run

    slim = known.select("prefix", "node", "n").filter("n > 0")
    columns = "token long, node long, n long"
    rare = slim.mapInArrow(explode(False), columns).repartition("token").sortWithinPartitions("token", "n", "node")

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by shingle and size: (leader, class) of each shingle that several classes have, between gaps in size
        that no similarity bridges."""
        carried = None  # token, size, whether it began a group, its leader and the leader's size
        for batch in batches:
            if not batch.num_rows:
                continue
            token, node, n = (batch.column(c).to_numpy() for c in ("token", "node", "n"))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (percent * n[1:] > 100 * n[:-1])
            if carried:
                new[0] = token[0] != carried[0] or percent * n[0] > 100 * carried[1]
            first = np.maximum.accumulate(np.where(new, np.arange(len(token)), -1))
            head = np.where(first < 0, carried[3] if carried else 0, node[first])
            size = np.where(first < 0, carried[4] if carried else 0, n[first])
            second = ~new & np.concatenate([[bool(carried and carried[2])], new[:-1]])
            carried = (token[-1], n[-1], bool(new[-1]), head[-1], size[-1])
            rows = (np.concatenate([head[~new], head[second]]), np.concatenate([node[~new], head[second]]), np.concatenate([n[~new], size[second]]))
            # several shingles of a batch name the same leader
            key, count = np.unique(np.stack(rows, axis=1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(key[:, i].copy()) for i in range(3)], pa.array(count.astype(np.int64))], names=["leader", "node", "n", "shared"])

    group = "leader long, node long, n long, shared long"
    members = rare.mapInArrow(lead, group)
    hot = slim.mapInArrow(explode(True), columns).groupBy("token").agg(F.min("node").alias("leader")).toArrow()  # as many rows as common shingles at the most
    order = np.argsort(hot.column("token").to_numpy())
    leaders = spark.sparkContext.broadcast((hot.column("token").to_numpy()[order], hot.column("leader").to_numpy()[order]))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, leader = leaders.value
        for batch in explode(True)(batches):
            if batch.num_rows:
                lead_ = leader[np.searchsorted(token, batch.column("token").to_numpy())]
                rows, count = np.unique(np.stack([lead_, batch.column("node").to_numpy(), batch.column("n").to_numpy()], axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(rows[:, i].copy()) for i in range(3)], pa.array(count.astype(np.int64))], names=["leader", "node", "n", "shared"])

    # rows of equal documents name the same class: counted once for each, which is never too few
    members = members.unionByName(slim.mapInArrow(follow, group)).groupBy("leader", "node").agg(F.max("n").alias("n"), F.sum("shared").alias("shared"))
    members = materialize(members, "shingle-members")
    least = F.floor((F.col("n") * percent + 99) / 100 / SHARE) + 1
    able = members.groupBy("node").agg(F.sum("shared").alias("shared"), F.max("n").alias("n")).filter(F.col("shared") >= least).select("node")
    members = members.join(able, "node", "left_semi")
    several = members.groupBy("leader").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("leader")
    members = materialize(members.join(several, "leader", "left_semi").select("leader", "node", "n"), "shingle-groups")

    classes = known.groupBy("node").agg(F.min(F.struct("_id", "_h")).alias("rep"), F.min("_id").alias("least"), F.first("n").alias("n"))
    sizes = members.groupBy("leader").agg(F.sum("n").alias("shingles"))
    parts = F.ceil(F.col("shingles") / F.lit(block)).cast("long").alias("parts")
    sizes = materialize(sizes.select("leader", parts), "shingle-parts")
    salt = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = members.join(sizes, "leader").select("leader", "node", "parts", salt.alias("part"))
    # the leader is in every part of a group that has several
    dealt = dealt.unionByName(sizes.filter("parts > 1").select("leader", F.col("leader").alias("node"), "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
    reps = classes.select("node", F.col("rep._id").alias("_id"), F.col("rep._h").alias("_h"))
    sent = dealt.join(reps, "node").select("node", "_id", "_h", F.xxhash64("leader", "part").alias("grp"), F.col("node").alias("label"), F.lit(True).alias("probe"))
    links = materialize(_meet(sent, own, percent, words), "shingle-links")

    large = sizes.filter("parts > 1")
    if large.limit(1).count():
        links = links.unionByName(_leftover_links(links, dealt.join(large.select("leader"), "leader", "left_semi"), reps, own, percent, words, block))
    labels = components(links)
    named = classes.select("node", "n", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = named.filter("n > 0")
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    by_class = named.join(least, "label").select("node", "component")
    out = known.select("_id", "_h", "n", "node").join(by_class, "node", "left")
    return out.select(F.col("_id").alias("id"), "_h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component"))


def _leftover_links(links: DataFrame, dealt: DataFrame, reps: DataFrame, own: DataFrame, percent: int, words: int, block: int) -> DataFrame:
    """Links between the blocks of large groups: classes not connected with their leader meet every block."""
    labels = components(links)
    at = dealt.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    head = at.filter("node = leader").select("leader", F.col("label").alias("main")).distinct()
    at = materialize(at.join(head, "leader"), "shingle-blocks")
    left = at.filter("label <> main and node <> leader")
    count = left.groupBy("leader").agg(F.count(F.lit(1)).alias("left"))
    cells = F.ceil(F.col("left") / F.lit(1024)).cast("long")
    grid = materialize(count.select("leader", cells.alias("cells")), "shingle-grid")
    # every block of such a group once for each cell of left classes, and each left class once for every block
    blocks = at.join(grid, "leader").select("leader", "part", "node", "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), F.lit(False).alias("probe"))
    cell = F.pmod(F.xxhash64("node", F.lit(1)), F.col("cells"))
    probes = left.join(grid, "leader").select(
        "leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "node", "label", cell.alias("cell"), F.lit(True).alias("probe")
    )
    sent = blocks.unionByName(probes).join(reps, "node").select("node", "_id", "_h", F.xxhash64("leader", "part", "cell").alias("grp"), "label", "probe")
    return materialize(_meet(sent, own, percent, words), "shingle-links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of its smallest id, with all its columns. Rows without words stay, but one that is there twice stays once."""
    found = materialize(similar_components(docs, id_col, text_col, words, percent), "shingle-components")
    linked = found.filter("n_shingles > 0 and id = component").groupBy("id").agg(F.min("_h").alias("_h"))
    # rows of a component without any id all stay
    linked = linked.unionByName(found.filter("n_shingles > 0 and component is null").select("id", "_h"))
    kept = linked.unionByName(found.filter("n_shingles = 0").select("id", "_h")).distinct().select(F.col("id").alias("__id"), F.col("_h").alias("__h"))
    own_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = docs.withColumn("__text_hash", own_hash).join(kept.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__h")), "left_semi")
    twice = found.groupBy("id", "_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    return (out.dropDuplicates([id_col, "__text_hash"]) if twice else out).drop("__text_hash")


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    out = similar_components(read(spark, folder, "documents", "doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""
QUERIES = {"op10_jaccard_join": op10_jaccard_join}
ORACLES = {"op10_jaccard_join": SQL}
