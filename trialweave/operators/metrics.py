"""Evaluation metrics and metric series. A series is a long table (run, step, value)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.lookup import salted_lookup
from ..plans.ordered import id_levels, number_rows, running_before, trailing_rows

IGNORE_LABEL = -100
CHARS_PER_TOKEN = 4.0  # Fixed value: characters assumed per token


def limit_batches(df: DataFrame, max_eval_steps: int | None, batch: str = "batch_id") -> DataFrame:
    """Only the first batches; a pushed-down filter."""
    return df.filter(F.col(batch) < max_eval_steps) if max_eval_steps else df


def eval_loss(df: DataFrame, keys: Sequence[str] = (), batch: str = "batch_id", loss: str = "loss", weighting: str = "batch") -> DataFrame:
    """Mean of the batch means (a short batch weighs as much as a full one), or the mean over
    samples with ``weighting='sample'``. Without any row the loss is 0."""
    if weighting == "batch":
        df = df.groupBy(*keys, batch).agg(F.avg(loss).alias(loss))
    return df.groupBy(*keys).agg(F.coalesce(F.avg(loss), F.lit(0.0)).alias("loss"))


def accuracy(df: DataFrame, keys: Sequence[str] = (), pred: str = "pred", label: str = "label") -> DataFrame:
    """Share of right predictions; no row where there are no samples."""
    hit = (F.col(pred) == F.col(label)).cast("bigint")
    out = df.groupBy(*keys).agg(F.sum(hit).alias("_hit"), F.count(F.lit(1)).alias("samples"))
    return out.filter("samples > 0").select(*keys, "samples", (F.col("_hit") / F.col("samples")).alias("accuracy"))


def token_accuracy(df: DataFrame, pred: str = "pred", labels: str = "labels") -> DataFrame:
    """Next-token accuracy: prediction i against label i+1, ignored labels left out; 0 if
    nothing remains."""
    n = F.greatest(F.size(labels) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(F.col(pred), F.lit(1), n).alias("p"), F.slice(F.col(labels), F.lit(2), n).alias("l"))
    valid = F.filter(pairs, lambda x: x["l"] != IGNORE_LABEL)
    hits = F.filter(valid, lambda x: x["l"] == x["p"])
    sums = df.agg(F.sum(F.size(hits)).alias("h"), F.sum(F.size(valid)).alias("n"))
    return sums.select(
        F.coalesce("n", F.lit(0)).alias("tokens"), F.when(F.col("n") > 0, F.col("h") / F.col("n")).otherwise(0.0).alias("accuracy")
    )


def perplexity(loss: Column) -> Column:
    return F.exp(loss)  # overflows to infinity


def bits_per_byte(loss: Column, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    return loss * F.lit(math.log2(math.e)) / F.lit(chars_per_token)


def primary_metric(metric: str, eval_metrics: Column, train_loss: Column) -> Column:
    """``eval_*`` metrics come from the last evaluation, all else is the mean training loss."""
    if not metric.startswith("eval_"):
        return train_loss
    return F.coalesce(F.try_element_at(eval_metrics, F.lit(metric.replace("eval_", ""))), train_loss)


def eval_points(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    return df.filter(F.col(step) % every == 0)


def _signed(value: Column, direction: str) -> Column:
    if direction not in ("minimize", "maximize"):
        raise ValueError(direction)
    return value if direction == "minimize" else -value


def improved(
    df: DataFrame, keys: Sequence[str] = ("run",), step: str = "step", value: str = "value", direction: str = "minimize",
    carry: DataFrame | None = None,
) -> DataFrame:
    """Adds ``improved``: strictly better than every value before. The first value always is;
    NaN never is, and a series that starts with NaN keeps it as its best.

    ``carry`` (keys, best, stuck) tells of series that have begun before these rows: their best
    value, and whether they started with NaN.
    """
    keys = list(keys)
    v = _signed(F.col(value), direction)
    real = F.when(~F.isnan(v), v)
    out = running_before(
        df, keys, id_levels(F.col(step)), [F.col(step)],
        {"_best": (real, "min"), "_seen": (F.lit(1).cast("bigint"), "sum")},
    )
    series = df.groupBy(*keys).agg(F.min_by(F.isnan(value), step).alias("_nan"))
    if carry is None:
        series = series.withColumns({"_c_best": F.lit(None).cast("double"), "_begun": F.lit(False)})
    else:
        before = carry.select(*keys, _signed(F.col("best"), direction).alias("_c_best"), F.col("stuck").alias("_c_stuck"))
        series = series.join(before, keys, "left").withColumn("_begun", F.col("_c_stuck").isNotNull())
        series = series.withColumn("_nan", F.coalesce("_c_stuck", "_nan")).drop("_c_stuck")
    out = salted_lookup(out, series, keys, [step])
    best = F.least("_best", "_c_best")
    better = ~F.col("_nan") & ~F.isnan(v) & (best.isNull() | (v < best))
    first = (F.col("_seen") == 0) & ~F.col("_begun")
    return out.withColumn("improved", F.when(first, True).otherwise(better)).drop("_best", "_seen", "_nan", "_c_best", "_begun")


def latest(df: DataFrame, keys: Sequence[str] = ("run",), step: str = "step", value: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(value, step).alias("latest"))


def _best(step: str, value: str, direction: str) -> Column:
    v = _signed(F.col(value), direction)
    own = F.min(F.when(~F.isnan(v), F.struct(v.alias("v"), F.col(step).alias("s"))))
    first = F.min(F.struct(F.col(step).alias("s"), v.alias("v")))
    stuck = F.isnan(first["v"])
    return F.struct(
        F.when(stuck, first["v"]).otherwise(_signed(own["v"], direction)).alias("value"),
        F.when(stuck, first["s"]).otherwise(own["s"]).alias("step"),
    )


def best(df: DataFrame, keys: Sequence[str] = ("run",), step: str = "step", value: str = "value", direction: str = "minimize") -> DataFrame:
    """Best value and the earliest step that reached it."""
    out = df.groupBy(*keys).agg(_best(step, value, direction).alias("b"))
    return out.select(*keys, F.col("b.value").alias("best"), F.col("b.step").alias("best_step"))


def running_average(df: DataFrame, keys: Sequence[str] = ("run",), step: str = "step", value: str = "value", window: int = 10) -> DataFrame:
    """Adds the mean over the last ``window`` values up to each step."""
    seq = number_rows(df, keys, id_levels(F.col(step)), [F.col(step)], "_seq")
    return trailing_rows(seq, keys, "_seq", window, {"running_avg": lambda w: F.avg(value).over(w)}).drop("_seq")


def metric_summary(df: DataFrame, keys: Sequence[str] = ("run",), step: str = "step", value: str = "value", direction: str = "minimize") -> DataFrame:
    """latest, best, best_step, avg_last_10 and n_values per series."""
    # rank <= 10 lets every task keep 10 rows per series before the shuffle
    last = df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(step)))).filter("_r <= 10")
    tail = last.groupBy(*keys).agg(F.avg(value).alias("avg_last_10"))
    whole = df.groupBy(*keys).agg(
        F.max_by(value, step).alias("latest"), _best(step, value, direction).alias("b"), F.count(F.lit(1)).alias("n_values")
    )
    return whole.join(tail, list(keys)).select(
        *keys, "latest", F.col("b.value").alias("best"), F.col("b.step").alias("best_step"), "avg_last_10", "n_values"
    )
