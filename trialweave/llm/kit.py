"""Helpers shared by the training-data operators: columns, keys, sorted streams of groups."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import discard, fresh_path, materialize, shared_dir  # noqa: F401

# task functions travel with their code, so executors need not have the library installed
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: A blank is one of these; everything else belongs to words.
BLANKS = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates a column once and hands it to an expression that uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality of the named columns, nulls being equal to each other."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def keyed(docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``_id``, ``_text`` (null text: empty), ``_h`` (hash of the text) and, in a struct ``_keep``, those named by ``keep``.

    Rows are told apart by id and text, so ids that are null or repeated are no special case; rows equal in both
    are the same document written twice and get the same result. Other columns, whatever their names, are left behind.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [F.struct(*keep).alias("_keep")] if keep else []
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), *kept).withColumn("_h", F.xxhash64("_text"))


def schema_with(df: DataFrame, names: dict[str, str], more: str) -> T.StructType:
    """Some columns of a table under new names, followed by the columns of a DDL string."""
    fields = [T.StructField(new, df.schema[old].dataType) for old, new in names.items() if old in df.columns]
    return T.StructType(fields + T.StructType.fromDDL(more).fields)


def join_text(texts: DataFrame, facts: DataFrame, how: str = "left") -> DataFrame:
    """Joins per-document facts (one row for each ``_id`` and ``_h``) to texts.

    The facts are the build side of a hash join, so that texts are shuffled but not sorted.
    """
    facts = facts.select(F.col("_id").alias("_fid"), F.col("_h").alias("_fh"), *[c for c in facts.columns if c not in ("_id", "_h")])
    cond = texts["_id"].eqNullSafe(facts["_fid"]) & (texts["_h"] == facts["_fh"])
    return texts.join(facts.hint("shuffle_hash"), cond, how).drop("_fid", "_fh")


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, most_bytes: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``: as many groups as reach ``most_bytes``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        start = 0
        if size >= most_bytes and held:
            last = held[-1].column(batch.schema.get_field_index(key))[held[-1].num_rows - 1]
            while start < batch.num_rows and keys[start] == last:
                start += 1
            if start:
                held.append(batch.slice(0, start))
            if start == batch.num_rows:  # the group goes on beyond this batch
                continue
            yield pa.Table.from_batches(held)
            held, size = [], 0
        rest = batch.slice(start)
        held.append(rest)
        size += rest.nbytes
    if held:
        yield pa.Table.from_batches(held)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, most: int = 4000) -> Iterator[pa.RecordBatch]:
    """Record batches from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
