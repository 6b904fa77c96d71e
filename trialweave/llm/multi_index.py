"""Nearest neighbours by largest inner product through an inverted multi-index.

Vectors are cut into halves, and each half is quantised by its own centroids (k-means on at most ``SAMPLE`` vectors). A cell is a pair of
centroids; every distinct vector is in the index, under its cell. A query orders the centroids of each half by its inner product with them, and a heap
walks the pairs by their summed products until the cells seen hold ``reach`` vectors, or ``share`` of all, whichever is more. Those are reranked exactly, in
double precision, by products of blocks: the queries that ask for cells of one first centroid against the vectors there, both in salted parts of bounded size.
No vector of a cell is worth more than the product with the centroids and the query's length times the cell's radius. In a second round every cell left
that could so reach the last score found is reranked, too: the result is exact, and ``reach`` and ``share`` only divide the work between the rounds.

Equal vectors are one entry that carries the ``k + 1`` smallest ids of its rows; no more of them can be among the ``k`` nearest of any query, so a vector
that a third of all rows share costs no more than another. Queries with equal vectors are searched once.

Defined results: rows without id, and vectors that are null, zero, not finite or not of the commonest length, take no part; an id that is there twice
with equal vectors is one row; ties go to the smaller id; with fewer than ``k`` candidates all come back; with no vectors nothing does.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import batches_of, materialize, read

K, REACH, SHARE, SAMPLE = 20, 6000, 0.0, 20_000
#: Vectors to a cell aimed at, and the most centroids of a half: there are at most ``MOST_CENTROIDS ** 2`` cells.
PER_CELL, MOST_CENTROIDS, PART = 32, 1024, 4096
#: Queries of a block, about.
BLOCK = 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part."""
    out = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = out.filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    common = out.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "d").first()
    return out.filter(F.size("v") == (common["d"] if common else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row per vector: ``key`` (its smallest id), ``v`` and ``ids``, its ``k + 1`` smallest."""
    # the rank limit is applied before the shuffle, too
    w = W.partitionBy("v").orderBy("id")
    first = rows.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("key"), "v", "ids")


def centroids(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread starting points, by plain sums (no threads on the driver)."""
    order = np.argsort(x[:, 0], kind="stable")
    c = x[order[np.linspace(0, len(x) - 1, n).astype(int)]].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(axis=1) - 2 * np.einsum("ij,kj->ik", x, c), axis=1)
        count = np.bincount(near, minlength=n)
        for j in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, j], minlength=n)
            c[:, j] = np.where(count > 0, total / np.maximum(count, 1), c[:, j])
    return c


def walk_cells(a: np.ndarray, b: np.ndarray, held: np.ndarray, reach: int) -> list[int]:
    """Cells in the order of the summed products of their centroids, until they hold ``reach`` vectors. ``held``: vectors per cell."""
    n = len(b)
    first, second = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    sa, sb = a[first].tolist(), b[second].tolist()
    heap = [(-sa[0] - sb[0], 0, 0)]
    out, seen = [], 0
    while heap and seen < reach:
        _, i, j = heapq.heappop(heap)
        if j + 1 < len(sb):
            heapq.heappush(heap, (-sa[i] - sb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(sa):
            heapq.heappush(heap, (-sa[i + 1] - sb[0], i + 1, 0))
        cell = int(first[i]) * n + int(second[j])
        if held[cell]:
            out.append(cell)
            seen += int(held[cell])
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last."""
    out = np.zeros((len(q), len(x)))
    for d in range(q.shape[1]):
        out += q[:, d, None] * x[None, :, d]
    return out


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, reach: int = REACH, sample: int = SAMPLE, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` nearest. ``is_query`` is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    index = materialize(distinct_vectors(rows, k), "vectors")
    total = index.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fit = index.orderBy(F.xxhash64("key"), "key").limit(sample).select("v").toArrow()
    x = np.array(fit.column("v").to_pylist(), np.float64)
    half = max(1, x.shape[1] // 2)
    n = int(min(MOST_CENTROIDS, len(x), max(1, round((total / PER_CELL) ** 0.5))))
    c1 = centroids(x[:, :half], n)
    c2 = centroids(x[:, half:], n) if x.shape[1] > half else np.zeros((1, 0))
    n2 = len(c2)

    def matrix(column) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy().reshape(len(column), -1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"))
                near = [np.argmin((c * c).sum(axis=1) - 2 * v[:, cut] @ c.T, axis=1) for c, cut in ((c1, slice(None, half)), (c2, slice(half, None)))]
                far = np.sqrt(((v - np.hstack([c1[near[0]], c2[near[1]]])) ** 2).sum(axis=1))
                yield batch.append_column("cell", pa.array(near[0] * n2 + near[1], pa.int64())).append_column("far", pa.array(far))

    cells = materialize(index.mapInArrow(assign, "key long, v array<double>, ids array<bigint>, cell long, far double"), "vector-cells")
    count = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).toArrow()  # at most MOST_CENTROIDS ** 2 rows
    held, radius = np.zeros(n * n2, np.int64), np.zeros(n * n2)
    held[count.column("cell").to_numpy()] = count.column("n").to_numpy()
    radius[count.column("cell").to_numpy()] = count.column("far").to_numpy()
    # beyond a rounding error of the products
    radius += 1e-9 * (radius + np.sqrt((c1 * c1).sum(axis=1)[:, None] + (c2 * c2).sum(axis=1)[None, :]).ravel())
    shared = spark.sparkContext.broadcast((held, radius))
    strips = held.reshape(n, n2).sum(axis=1)
    reach = max(reach, int(share * total))

    queries = rows.filter(is_query).select(F.col("id").alias("query_id"), "v").distinct()
    queries = materialize(queries.join(index.select("key", "v"), "v").select("query_id", "key"), "vector-queries")
    asked = index.join(queries.select("key").distinct(), "key", "left_semi")
    blocks = max(1, -(-asked.count() // block))
    asked = asked.select("key", "v", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row", pa.int64()), ("strip", pa.int64()), ("part", pa.int64()), ("seconds", pa.list_(pa.int64()))])
        for batch in batches:
            if not batch.num_rows:
                continue
            v, (held, radius) = matrix(batch.column("v")), shared.value
            least = batch.column("least").to_numpy(zero_copy_only=False) if "least" in batch.schema.names else None
            a, b = v[:, :half] @ c1.T, v[:, half:] @ c2.T

            def pairs(a=a, b=b, v=v, held=held, radius=radius, least=least):
                for i in range(len(a)):
                    seconds: dict[int, list[int]] = {}
                    asks = walk_cells(a[i], b[i], held, reach)
                    if least is not None:
                        most = (a[i][:, None] + b[i][None, :]).ravel() + np.sqrt((v[i] * v[i]).sum()) * radius
                        left = (held > 0) & ~(most < least[i])
                        left[asks] = False
                        asks = np.flatnonzero(left).tolist()
                    for cell in asks:
                        seconds.setdefault(cell // n2, []).append(cell % n2)
                    for strip, found in seconds.items():
                        for part in range(-(-int(strips[strip]) // PART)):
                            yield i, strip, part, found

            for out in batches_of(pairs(), schema, 20_000):
                take = out.column("row")
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in ("key", "v", "block")], *out.columns[1:]], names=["key", "v", "block", *schema.names[1:]])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strip = batch.column("cell").to_numpy() // n2
            parts = -(-strips[strip] // PART)
            key = batch.column("key").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            part = ((key >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)
            yield batch.append_column("strip", pa.array(strip)).append_column("part", pa.array(part))

    entries = cells.drop("far").mapInArrow(split, "key long, v array<double>, ids array<bigint>, cell long, strip long, part long")
    entries = entries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rerank(asking: pa.Table, entries: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if asking.num_rows and entries.num_rows:
            x, q = matrix(entries.column("v")), matrix(asking.column("v"))
            own = entries.column("ids").to_pylist()
            second = entries.column("cell").to_numpy() % n2
            for at in range(0, len(q), 128):
                block = products(q[at : at + 128], x)
                seen = np.zeros((len(block), n2), bool)
                for row, cells_ in enumerate(asking.column("seconds")[at : at + 128].to_pylist()):
                    seen[row, cells_] = True
                block[~seen[:, second]] = -np.inf
                for key, s in zip(asking.column("key")[at : at + 128].to_pylist(), block):
                    least = np.partition(s, -(k + 1))[-(k + 1)] if len(s) > k + 1 else -np.inf
                    found = sorted((-s[e], i) for e in np.flatnonzero((s >= least) & (s > -np.inf)).tolist() for i in own[e])[: k + 1]
                    keys.append(key)
                    ids.append([i for _, i in found])
                    scores.append([-m for m, _ in found])
        return pa.table({"key": pa.array(keys, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())), "scores": pa.array(scores, pa.list_(pa.float64()))})

    def search(asking: DataFrame) -> DataFrame:
        routed = asking.repartition("key").mapInArrow(route, "key long, v array<double>, block long, strip long, part long, seconds array<bigint>")
        group = ["strip", "part", "block"]
        found = routed.groupBy(*group).cogroup(entries.groupBy(*group)).applyInArrow(rerank, "key long, ids array<bigint>, scores array<double>")
        return found.select("key", F.arrays_zip(F.transform("scores", lambda s: -s).alias("m"), F.col("ids").alias("i")).alias("z"))

    def merged(found: DataFrame) -> DataFrame:
        return found.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list("z"))), 1, k + 1).alias("z"))

    first = materialize(merged(search(asked)), "vector-first")
    least = F.when(F.size("z") > k, -F.col("z")[k]["m"]).otherwise(F.lit(float("-inf")))
    best = merged(first.unionByName(search(asked.join(first.select("key", least.alias("least")), "key"))))
    per_query = queries.join(best, "key").select("query_id", F.slice(F.filter("z", lambda z: z["i"] != F.col("query_id")), 1, k).alias("z"))
    out = per_query.select("query_id", F.posexplode("z").alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.m")).alias("score"))


def op6_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(read(spark, folder, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


SQL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) AS score
 FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
QUERIES = {"op6_multi_index": op6_multi_index}
ORACLES = {"op6_multi_index": SQL}
