"""Stored trials, run logs and training results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIAL_COLUMNS = {
    "trial_id": "bigint",
    "timestamp": "timestamp",
    "config_hash": "string",
    "augmentations_json": "string",
    "tuning_json": "string",
    "metrics_json": "string",
    "primary_metric": "double",
    "decision": "string",
    "reason": "string",
    "diff_json": "string",
    "branch_name": "string",
    "pr_url": "string",
}
# What a trial record holds when a field is not given.
TRIAL_DEFAULTS = {
    "decision": "unknown",
    "augmentations_json": "{}",
    "tuning_json": "{}",
    "metrics_json": "{}",
    "diff_json": "[]",
}

RUN_LOG_SCHEMA = (
    "name string, config string, tags map<string,string>, metrics array<map<string,double>>, "
    "artifacts array<struct<path:string,type:string>>, accepted boolean, reason string, "
    "started_at string, ended_at string"
)


def complete_trials(df: DataFrame) -> DataFrame:
    """All trial columns, with defaults where a field is absent or null."""
    out = []
    for name, kind in TRIAL_COLUMNS.items():
        c = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if name == "timestamp":
            c = F.coalesce(c, F.current_timestamp())
        elif name in TRIAL_DEFAULTS:
            c = F.coalesce(c, F.lit(TRIAL_DEFAULTS[name]))
        out.append(c.alias(name))
    return df.select(*out)


def append_trials(df: DataFrame, path: str) -> None:
    """Appends to the trials table, partitioned by decision so that a read of the accepted
    trials opens only their files."""
    complete_trials(df).write.mode("append").partitionBy("decision").parquet(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{n} {k}" for n, k in TRIAL_COLUMNS.items())
    return spark.read.schema(schema).parquet(path).select(*TRIAL_COLUMNS)


def write_results(df: DataFrame, path: str, key: str = "trial_id") -> None:
    """One nested row per trial (loss, evaluation map, history, steps, elapsed time). A range of
    trials shares a file; a reader finds its trial through the statistics in the files."""
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("append").parquet(path)


def read_run_logs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Run logs, one JSON object per run; ``multi_line`` for files holding one indented object."""
    return spark.read.schema(RUN_LOG_SCHEMA).option("multiLine", multi_line).json(path)


def metric_rows(logs: DataFrame) -> DataFrame:
    """(run, step, metric, value): every logged value as a row."""
    points = logs.select(F.col("name").alias("run"), F.explode("metrics").alias("m"))
    return points.select(
        "run", F.col("m")["step"].cast("bigint").alias("step"), F.explode(F.map_filter("m", lambda k, v: k != "step")).alias("metric", "value")
    )


def artifact_rows(logs: DataFrame) -> DataFrame:
    return logs.select(F.col("name").alias("run"), F.explode("artifacts").alias("a")).select("run", "a.path", "a.type")
