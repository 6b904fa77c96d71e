"""Reading the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.session import spread


def table(spark: SparkSession, folder: str, name: str, *columns: str, many_tasks: bool = False) -> DataFrame:
    """A stored table, pruned to the named columns at the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if many_tasks else df
