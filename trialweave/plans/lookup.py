"""Lookups of row values in dimension tables whose keys are very unevenly used."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Chunks of texts for each shuffle partition: a partition of 100 to 200 MB gives chunks of some 10 MB.
CHUNKS_PER_PARTITION = 16

#: Tokens of chunks that a task gathers before it drops those it has.
DISTINCT_ROWS = 1_000_000


def salted_lookup(
    rows: DataFrame, dimension: DataFrame, on: list[str], salt_by: list[str], how: str = "left", salts: int = 8
) -> DataFrame:
    """Equi-join in which one hot key (the commonest word) is spread over ``salts`` tasks.

    The dimension holds each key once, so repeating it per salt is cheap. No broadcast is
    forced: Spark broadcasts the dimension by itself when its size is below the session's
    limit, and otherwise the salted shuffle join holds for any size of either side.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    right = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, on + ["_salt"], how).drop("_salt")


def sparse_lookup(rows: DataFrame, dimension: DataFrame, on: list[str], salt_by: list[str], how: str = "left") -> DataFrame:
    """A salted lookup for rows that ask for a small part of the dimension.

    The dimension is first cut down to the keys asked for. Every key is there once on both
    sides of that join, so it has no hot key, and only what is left is repeated per salt.
    """
    asked = rows.select(*on).distinct()
    return salted_lookup(rows, dimension.join(asked, on, "left_semi"), on, salt_by, how)


def chunk_lookup(rows: DataFrame, key: str, tokens: str, find: Callable[[DataFrame], DataFrame], out: str, kind: T.DataType, chunks: int | None = None, keep: bool = True, missing: int | str | None = None) -> DataFrame:
    """Adds ``out``: for each of a row's tokens its value in a dictionary, ``missing`` where it has none. Without ``keep`` the tokens do not come back.

    Rows are dealt by key into chunks, and only the distinct tokens of a chunk look for their values, so the commonest word is asked for once a chunk and tokens are not
    shuffled. ``find`` gets ``chunk`` and ``tok`` and returns them with ``value``, once each. Values come back to their chunk, whose rows are then translated together by Arrow's
    kernels. A chunk is held by one task; its size follows from the number of shuffle partitions (or of ``chunks``).
    """
    spark = rows.sparkSession
    chunks = chunks or CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")).repartition("_chunk")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, least = [], 0, DISTINCT_ROWS

        def once() -> pa.Table:
            return pa.concat_tables(held).group_by(["chunk", "tok"]).aggregate([]).select(["chunk", "tok"])

        for batch in batches:
            column, chunk = batch.column(tokens), batch.column("_chunk")
            pairs = pa.table({"chunk": chunk.take(pc.list_parent_indices(column)), "tok": column.flatten()})
            held.append(pairs.group_by(["chunk", "tok"]).aggregate([]).select(["chunk", "tok"]))
            size += len(held[-1])
            if size > least:
                held = [once()]
                size = len(held[0])
                least = 2 * size + DISTINCT_ROWS
        if held:
            yield from once().to_batches(DISTINCT_ROWS)

    # A chunk is one task's, so what is distinct there is distinct, and this takes no shuffle of its own. All columns are read, so that these rows are the
    # ones translated below and are dealt out once.
    kind_of = rows.schema[tokens].dataType.elementType.simpleString()
    asked = dealt.mapInArrow(distinct, f"chunk int, tok {kind_of}")
    found = find(asked).select(F.col("chunk").alias("_chunk"), "tok", "value")
    kept = [f for f in rows.schema.fields if keep or f.name != tokens]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(kind))])

    def translate(texts: pa.Table, known: pa.Table) -> pa.Table:
        column = texts.column(tokens).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        flat = column.flatten()
        places = pc.index_in(flat, value_set=known.column("tok").combine_chunks())
        values = known.column("value").combine_chunks().take(places)
        if missing is not None:
            values = pc.fill_null(values, missing)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return texts.drop_columns(["_chunk"] if keep else ["_chunk", tokens]).append_column(out, pa.ListArray.from_arrays(offsets, values, mask=column.is_null()))

    return dealt.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(translate, schema)
