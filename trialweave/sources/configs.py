"""Configs as tables of JSON documents."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def yaml_to_json(df: DataFrame, key: str, text: str, out: str = "config") -> DataFrame:
    """(key, out): YAML documents as JSON; null for text that is not a YAML mapping."""

    def parse(batches: Iterator) -> Iterator:
        import json

        import yaml

        for pdf in batches:
            docs = []
            for t in pdf[text]:
                try:
                    doc = yaml.safe_load(t) if isinstance(t, str) else None
                    docs.append(json.dumps(doc, default=str) if isinstance(doc, dict) else None)
                except (yaml.YAMLError, ValueError, TypeError, OverflowError, RecursionError):  # dates that are none, keys JSON lacks
                    docs.append(None)
            yield pdf[[key]].assign(**{out: docs})

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInPandas(parse, f"`{key}` {kind}, `{out}` string")


def read_configs(df: DataFrame, key: str = "config_id", text: str = "config", fmt: str = "json") -> DataFrame:
    """(key, config): config documents as JSON strings that are known to be objects."""
    rows = yaml_to_json(df, key, text) if fmt == "yaml" else df.select(key, F.col(text).alias("config"))
    return rows.filter(F.json_object_keys("config").isNotNull())


def read_config_files(spark: SparkSession, path: str, fmt: str = "yaml") -> DataFrame:
    """(config_id, config): every file under a path is one config, named by its address."""
    files = spark.read.text(path, wholetext=True)
    return read_configs(files.select(F.input_file_name().alias("config_id"), F.col("value").alias("config")), fmt=fmt)
