"""Whitens embeddings: projects them on the principal components of their distinct values, scaled to unit variance, with MLlib's ``BlockMatrix``.

An entry ``c`` becomes the whole number ``floor(scale * c)``, so that sums and deviations are exact. The fit list holds each distinct vector once; its ``n`` vectors ``x``
have the sums ``S``.

1. Rows are numbered by the task that wrote them and their place in it, and dealt into blocks of a bounded number of rows; the centred rows ``(n * x - S) / n`` of
   a block are one dense matrix.
2. *Scatter.* ``L.transpose().multiply(R)``, both of the blocks of the fit list, one block a row. Block ``b`` stands in block column ``i`` of ``L`` and ``j`` of ``R``, where
   ``(i, j)`` runs over a grid of ``side * side`` cells. Entry ``(i, j)`` of the product is then the scatter of the blocks dealt to that cell and nothing else, so
   the product of a tall matrix with itself is spread over all cells instead of being one task's; the cells' sums are the scatter.
3. *Components.* ``eigh`` of the covariance on the driver: the square of the dimension is all it holds.
4. *Projection.* The blocks of all rows stand in a grid of ``side`` columns and are multiplied by a block diagonal of the whitening matrix.

What is written (blocks of rows, ids and deviations) lies in the shared folder; a lost executor's blocks are made again from there. Equal vectors, however many, are one row of the
fit list after partial grouping and separate rows of the projection, so nothing is gathered by value.

Defined results: vectors that are null, empty or hold null or non-finite entries are dropped, and so are those with an entry that no 64-bit number can hold after scaling and those of another length
than the commonest (the shorter of equally common ones); null or repeated ids are rows like others; components whose variance is zero to double precision
are left out, so one distinct vector gives no rows, and neither does an empty table; a deviation beyond 64 bits is null; the sign of a component is that which makes its largest entry positive.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import materialize, read

SCALE, COMPONENTS = 256, 4
#: Numbers of a block; rows of a block follow from the dimension.
BLOCK_VALUES, BLOCK_ROWS = 1 << 19, 1024
#: Bytes of centred rows that one cell of the scatter's grid should hold.
CELL_BYTES = 32 << 20
COLUMNS = "id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``id`` and ``x``, the whole numbers of the vectors that take part, with ``at``, a number of their own."""
    most = F.lit(float(1 << 62))
    v = F.transform(F.col("x"), lambda c: c.cast("double") * scale)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("x")).withColumn("x", v)
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < most))
    rows = rows.filter(F.col("x").isNotNull() & (F.size("x") > 0) & fine).withColumn("x", F.transform("x", lambda c: F.floor(c).cast("long")))
    rows = materialize(rows, "whitening-scaled")
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("x") == (size["d"] if size else 0))


def numbered(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """A stored table with ``block`` and ``slot`` of every row, blocks counted from 0, and their number."""
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "whitening-rows")
    rows = rows.withColumns({"part": F.shiftright("at", 33), "no": F.col("at").bitwiseAND((1 << 33) - 1)})
    first, blocks = [], 0
    for part, count in rows.groupBy("part").count().orderBy("part").collect():  # one row for each task that wrote
        first.append((part, blocks))
        blocks += -(-count // block_rows)
    starts = rows.sparkSession.createDataFrame(first, "part long, first long")
    block = F.col("first") + F.floor(F.col("no") / F.lit(block_rows)).cast("long")
    return rows.join(starts, "part").withColumns({"block": block, "slot": F.pmod("no", F.lit(block_rows))}).drop("at", "part", "no", "first"), blocks


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exactly: as 64-bit numbers where they fit, else as Python's."""
    big = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    return n * x - np.array(sums, np.int64) if big < 1 << 61 else n * x.astype(object) - np.array(sums, object)


def _deviations(diff: np.ndarray) -> list[int | None]:
    if diff.dtype != object and diff.size and int(np.abs(diff).max()) ** 2 * diff.shape[1] < 1 << 63:
        return (diff * diff).sum(axis=1).tolist()
    exact = (diff.astype(object) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def centred_blocks(rows: DataFrame, n: int, sums: list[int], block_rows: int) -> DataFrame:
    """One stored row a block: ``values`` (doubles, row by row, with zeros up to ``block_rows``), ``ids`` and ``deviations``."""
    d, id_type = len(sums), rows.schema["id"].dataType.simpleString()

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("slot")
        x = np.array(table.column("x").combine_chunks().flatten(), np.int64).reshape(-1, d)
        diff = _differences(x, n, sums)
        values = np.zeros((block_rows, d))
        values[: len(x)] = diff.astype(np.float64) / n
        ids = table.column("id").combine_chunks()
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "deviations": pa.array([_deviations(diff)], pa.list_(pa.int64())),
                "values": pa.array([values.tobytes()], pa.binary()),
            }
        )

    made = rows.groupBy("block").applyInArrow(build, f"block long, ids array<{id_type}>, deviations array<bigint>, values binary")
    return materialize(made, "whitening-blocks")


def block_matrix(blocks: DataFrame, place, shape: tuple[int, int], parts: int) -> BlockMatrix:
    """Stored blocks of ``shape``; ``place`` gives a block's (row, column) from its number."""
    h, d = shape

    def dense(r) -> tuple:
        return place(r["block"]), DenseMatrix(h, d, np.frombuffer(bytes(r["values"])), True)

    return BlockMatrix(blocks.select("block", "values").rdd.map(dense).repartition(parts), h, d)


def scatter(blocks: DataFrame, shape: tuple[int, int], side: int) -> np.ndarray:
    """The sum of ``x^T x`` over all rows of stored blocks."""
    left = block_matrix(blocks, lambda b: (b, b // side % side), shape, side * side)
    right = block_matrix(blocks, lambda b: (b, b % side), shape, side * side)
    cells = left.transpose().multiply(right).blocks.map(lambda cell: cell[1].toArray())
    return cells.treeReduce(np.add)


def project(blocks: DataFrame, shape: tuple[int, int], onto: np.ndarray, side: int) -> DataFrame:
    """``block`` and ``z``, its rows' projections one after the other."""
    spark, k = blocks.sparkSession, onto.shape[1]
    rows = block_matrix(blocks, lambda b: (b // side, b % side), shape, side * side)
    small = [((j, j), DenseMatrix(shape[1], k, onto.ravel(order="F").tolist())) for j in range(side)]
    diagonal = BlockMatrix(spark.sparkContext.parallelize(small, 1), shape[1], k)
    cells = rows.multiply(diagonal).blocks.map(lambda cell: (cell[0][0] * side + cell[0][1], cell[1].toArray().ravel().tolist()))
    return spark.createDataFrame(cells, "block long, z array<double>", verifySchema=False)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per row that takes part and component, from 1: ``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    spark = vectors.sparkSession
    rows = scaled(vectors, id_col, vec_col, scale)
    columns = COLUMNS.format(id=rows.schema["id"].dataType.simpleString())
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    n = fit.count()
    # low and high bits apart, so that no sum leaves 64 bits
    low = F.sum(F.col("c").bitwiseAND((1 << 26) - 1)).alias("low")
    totals = fit.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum(F.shiftright("c", 26)).alias("high"), low).orderBy("k").collect()
    sums = [(r["high"] << 26) + r["low"] for r in totals]
    d = len(sums)
    if n < 2:
        return spark.createDataFrame([], columns)
    shape = (max(16, min(BLOCK_ROWS, BLOCK_VALUES // d)), d)
    fit_rows, fit_blocks = numbered(fit.select(F.lit(0).alias("id"), "x"), shape[0])
    all_rows, all_blocks = numbered(rows.select("id", "x"), shape[0])
    cells = max(spark.sparkContext.defaultParallelism, -(-max(fit_blocks, all_blocks) * shape[0] * d * 8 // CELL_BYTES))
    side = max(1, min(math.isqrt(cells - 1) + 1, math.isqrt(fit_blocks - 1) + 1))
    fitted = centred_blocks(fit_rows, n, sums, shape[0])
    covariance = scatter(fitted, shape, side) / n
    covariance = (covariance + covariance.T) / 2
    value, vector = np.linalg.eigh(covariance)
    value, vector = value[::-1], vector[:, ::-1]
    trace = float(np.trace(covariance))
    k = min(components, int((value > trace * d * np.finfo(float).eps).sum()))
    if not k:
        return spark.createDataFrame([], columns)
    value, vector = value[:k], vector[:, :k]
    vector = vector * np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(k)])
    onto = vector / np.sqrt(value)

    def moments(r) -> np.ndarray:
        z = np.array(r["z"]).reshape(-1, k)  # rows that fill a block are zero
        return np.vstack([z.T @ z, z.sum(axis=0)])

    found = project(fitted, shape, onto, side).rdd.map(moments).treeReduce(np.add) / n
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())

    whole = centred_blocks(all_rows, n, sums, shape[0])
    return _rows(whole.select("block", "ids", "deviations"), project(whole, shape, onto, side), n, [float(v) / trace for v in value], error)


def _rows(whole: DataFrame, projected: DataFrame, n: int, explained: list[float], error: float) -> DataFrame:
    k = len(explained)
    rows = whole.join(projected, "block").select(F.posexplode(F.arrays_zip("ids", "deviations")).alias("slot", "row"), "z")
    share = F.array(*[F.lit(e) for e in explained])
    out = rows.select(F.col("row.ids").alias("id"), F.col("row.deviations").alias("deviation"), F.slice("z", F.col("slot") * k + 1, k).alias("z"))
    out = out.select("id", "deviation", F.posexplode("z").alias("c", "whitened"))
    return out.select("id", (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share[F.col("c")].alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read(spark, folder, "embeddings", "vec_id", "embedding")).withColumnRenamed("id", "vec_id")


QUERIES = {"op12_whitening": op12_whitening}
ORACLES: dict[str, str] = {}
