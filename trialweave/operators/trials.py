"""Trial analytics: decisions, the sequential gate with early stopping, history and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import fixed
from ..plans.lookup import salted_lookup
from ..plans.ordered import id_levels, range_cells, running_before
from ..plans.session import materialize

# The defaults of a run.
THRESHOLD = 0.005
PATIENCE = 10
EXPLORATION_TRIALS = 10
METRIC = "eval_loss"
FAILED = ("error", "failed")


def improvement(current: Column, reference: Column, direction: str = "minimize") -> Column:
    """Relative improvement; 0 against a reference of 0."""
    gain = reference - current if direction == "minimize" else current - reference
    return F.when(reference == 0, F.lit(0.0)).otherwise(F.try_divide(gain, F.abs(reference)))


def _optional(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def _reaches(gain: Column, threshold: float) -> Column:
    # NaN orders above every number here, but is no improvement
    return ~F.isnan(gain) & (gain >= F.lit(float(threshold)))


def primary_value(df: DataFrame, metric: str = METRIC) -> Column:
    """The primary metric of a trial, else the evaluation metric of the same short name."""
    value = F.col("primary_metric").cast("double")
    if "eval_metrics" in df.columns:
        short = metric.replace("eval_", "")
        value = F.coalesce(value, F.try_element_at("eval_metrics", F.lit(short)).cast("double"))
    return value


def raised(df: DataFrame) -> Column:
    """Trials with status 'exception'."""
    return F.coalesce(_optional(df, "status", F.lit(None).cast("string")) == "exception", F.lit(False))


def judged_values(df: DataFrame, metric: str = METRIC) -> tuple[Column, Column]:
    """For trials that neither failed nor are unsafe: their own primary metric, and the value under its short name where they have none."""
    failed = F.coalesce(_optional(df, "status", F.lit(None).cast("string")).isin(*FAILED), F.lit(False))
    judged = ~failed & F.coalesce(_optional(df, "safe", F.lit(True)), F.lit(True))
    own = F.col("primary_metric").cast("double")
    return F.when(judged, own), F.when(judged & own.isNull(), primary_value(df, metric))


def decide(
    df: DataFrame, metric: str = METRIC, direction: str = "minimize", threshold: float = THRESHOLD,
    baseline: str = "baseline", best: str = "best",
) -> DataFrame:
    """Adds ``accepted``, ``improvement`` and ``reason`` to rows that know their references.

    The rules in order: failed, metric missing, unsafe, first trial, threshold."""
    status = _optional(df, "status", F.lit(None).cast("string"))
    error = F.coalesce(_optional(df, "error", F.lit(None).cast("string")), F.lit("unknown error"))
    # steps that are used several times become columns, so that they are computed once
    df = df.withColumns(
        {
            "_value": primary_value(df, metric),
            "_ref": F.coalesce(F.col(best), F.col(baseline)),
            "_failed": F.coalesce(status.isin(*FAILED), F.lit(False)),
            "_safe": F.coalesce(_optional(df, "safe", F.lit(True)), F.lit(True)),
        }
    )
    value, ref, failed, safe = (F.col(c) for c in ("_value", "_ref", "_failed", "_safe"))
    df = df.withColumn("_gain", improvement(value, ref, direction))
    gain = F.col("_gain")
    judged = ~failed & value.isNotNull() & safe
    df = df.withColumn("accepted", F.coalesce(judged & (ref.isNull() | _reaches(gain, threshold)), F.lit(False)))
    df = df.withColumns(
        {
            "_g4": fixed(gain, 4), "_g2": fixed(gain * 100, 2), "_r4": fixed(ref, 4), "_v4": fixed(value, 4),
            "improvement": F.when(judged & ref.isNotNull(), gain).otherwise(0.0),
        }
    )
    against = F.when(F.col(best).isNotNull(), "best").otherwise("baseline")
    # The wording of the reasons.
    reason = (
        F.when(failed, F.concat(F.lit("Trial failed: "), error))
        .when(value.isNull(), F.lit(f"Primary metric '{metric}' not found in results"))
        .when(~safe, F.lit("Safety checks failed (PII detected or license incompatible)"))
        .when(ref.isNull(), F.lit("First trial — accepted as initial baseline"))
        .when(F.col("accepted"), F.format_string(f"Improved {metric} by %s (%s%%) over %s (%s → %s)", "_g4", "_g2", against, "_r4", "_v4"))
        .otherwise(
            F.format_string(
                f"Insufficient improvement: %s (%s%%) < threshold {threshold * 100:.2f}%% (current: %s, best: %s)",
                "_g4", "_g2", "_v4", "_r4",
            )
        )
    )
    return df.withColumn("reason", reason).drop("_value", "_ref", "_failed", "_safe", "_gain", "_g4", "_g2", "_r4", "_v4")


def largest_accepted(ref: np.ndarray, threshold: float) -> np.ndarray:
    """For each reference the largest value that still improves on it by the threshold, NaN where none does; exact, by halving the numbers between."""
    fine = np.isfinite(ref) & (ref != 0)
    r = np.where(fine, ref, 1.0)

    def number(key: np.ndarray) -> np.ndarray:  # whole numbers in the order of doubles
        return np.where(key < 0, np.iinfo(np.int64).min - key, key).view(np.float64)

    def key(x: np.ndarray) -> np.ndarray:
        i = np.ascontiguousarray(x).view(np.int64)
        return np.where(i < 0, np.iinfo(np.int64).min - i, i)

    with np.errstate(over="ignore", invalid="ignore"):
        good, bad = key(np.minimum(r - 2 * threshold * np.abs(r), np.nextafter(r, -np.inf))), key(r)
        for _ in range(64):
            middle = (good >> 1) + (bad >> 1) + (good & bad & 1)
            hit = (r - number(middle)) / np.abs(r) >= threshold
            good, bad = np.where(hit, middle, good), np.where(hit, bad, middle)
        return np.where(fine, number(good), np.nan)


def _accepted_chain(candidates: DataFrame, keys: Sequence[str], trial: str, threshold: float) -> DataFrame:
    """(keys, trial): the trials that move the best value, from candidates (keys, trial, _v, _base) whose values fall from one to the next.

    Every candidate points to the one that is accepted after it: the first below its bound, which is the largest value below it, found by a running maximum
    over cells of values. From the first accepted one the chain is followed by doubling: after k rounds what is reached from it in fewer than 2^k steps is
    known, and pointers lead 2^k steps on. No task holds an experiment's candidates."""
    keys = list(keys)
    nodes = candidates

    @F.pandas_udf("double")
    def bound(ref: pd.Series) -> pd.Series:
        return pd.Series(largest_accepted(ref.to_numpy(np.float64), threshold))

    first = nodes.groupBy(*keys).agg(F.min(F.struct(trial, "_base")).alias("f")).select(*keys, F.col(f"f.{trial}").alias("dst"), "f._base")
    real = nodes.filter(~F.isnan("_v"))
    asked = real.select(*keys, F.col(trial).alias("src"), F.col("_v").alias("ref")).unionByName(
        first.filter("_base IS NOT NULL").select(*keys, F.lit(None).cast(dict(nodes.dtypes)[trial]).alias("src"), F.col("_base").alias("ref"))
    )
    asked = asked.withColumn("at", bound("ref")).filter(~F.isnan("at")).select(*keys, "src", "at", F.lit(1).alias("asks"))
    values = real.select(*keys, F.col(trial).alias("own"), F.col("_v").alias("at"), F.lit(0).alias("asks"))
    order = [F.col("at"), F.col("asks")]
    cells = range_cells(asked.unionByName(values, allowMissingColumns=True), [*map(F.col, keys), *order])
    below = running_before(cells, keys, ["_l0", "_l1"], order, {"_to": (F.when(F.col("asks") == 0, F.struct("at", "own")), "max")})
    links = below.filter("asks = 1 AND _to IS NOT NULL").select(*keys, "src", F.col("_to.own").alias("dst"))
    starts = first.filter("_base IS NULL").select(*keys, F.lit(None).cast(dict(nodes.dtypes)[trial]).alias("src"), "dst")
    # rows without ``src`` are reached, the others are pointers; a round is one table
    now = materialize(links.unionByName(starts), "gate-links")
    reached = now.filter("src IS NULL")
    while True:
        step = now.filter("src IS NOT NULL").select(*keys, F.col("src").alias("dst"), F.col("dst").alias("_next"))
        fresh = reached.unionByName(now.filter("src IS NOT NULL"))
        now = materialize(fresh.join(step, [*keys, "dst"]).select(*keys, "src", F.col("_next").alias("dst")), "gate-links")
        more = now.filter("src IS NULL")
        if more.isEmpty():
            return reached.select(*keys, F.col("dst").alias(trial))
        reached = reached.unionByName(more)


def _accepted_fold(candidates: DataFrame, keys: Sequence[str], trial: str) -> DataFrame:
    """The same without a threshold, where ties and, once the best value is 0, any value move it, so that values need not fall: candidates are read in trial
    order, batch by batch, holding one number per experiment at a time."""
    keys = list(keys)
    kinds = dict(candidates.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, trial])

    def fold(batches: Iterator) -> Iterator:
        group, best = object(), None
        for pdf in batches:
            took = []
            for *k, v, base in zip(*(pdf[c] for c in keys), pdf["_v"], pdf["_base"]):
                if k != group:
                    group, best = k, None
                ref = best if best is not None else (None if base != base or base is None else base)
                ok = ref is None or (0.0 if ref == 0 else (ref - v) / abs(ref)) >= 0
                if ok:
                    best = v
                took.append(ok)
            yield pdf.loc[took, [*keys, trial]]

    return candidates.repartition(*keys).sortWithinPartitions(*keys, trial).mapInPandas(fold, schema)


def sequential_gate(
    trials: DataFrame, keys: Sequence[str] = ("experiment",), trial: str = "trial_id", metric: str = METRIC,
    direction: str = "minimize", threshold: float = THRESHOLD, baselines: DataFrame | None = None, patience: int | None = PATIENCE,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Decides every trial of every experiment in trial order.

    The best value moves only on acceptance. Trials with status 'exception' are left out, as
    they count neither as decisions nor towards patience. Adds ``best`` and ``baseline`` (the
    references a trial was held against), ``accepted``, ``improvement``, ``reason``, ``fails``
    (consecutive rejections up to and including this trial) and ``ran`` (false after
    ``patience`` rejections in a row).

    A trial that moves the best value must be better than all trials before it. Of these running records each points to the one
    accepted after it, and the chain of pointers is followed by doubling; finding records and pointers and carrying the result back to all
    trials are cell-wise running computations, whatever the size of an experiment.

    ``carry`` (keys, best, fails, stopped) is what earlier trials, decided before, have led to.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    keys = list(keys)
    rows = trials.filter(~raised(trials))
    rows = rows.withColumns(id_levels(F.col(trial)))
    if baselines is None:
        rows = rows.withColumn("baseline", F.lit(None).cast("double"))
    else:
        rows = salted_lookup(rows, baselines.select(*keys, F.col("baseline").cast("double")), keys, [trial])
    if carry is None:
        rows = rows.withColumns({"_c_best": F.lit(None).cast("double"), "_c_fails": F.lit(0).cast("bigint"), "_c_stop": F.lit(False)})
    else:
        known = carry.select(*keys, F.col("best").alias("_c_best"), F.col("fails").alias("_c_fails"), F.col("stopped").alias("_c_stop"))
        rows = salted_lookup(rows, known, keys, [trial]).na.fill({"_c_fails": 0, "_c_stop": False})
    levels = ["_l0", "_l1"]
    sign = 1 if direction == "minimize" else -1
    # a value found under its short name only is judged, but does not become the best value
    own = judged_values(rows, metric)[0] * sign
    real = F.when(~F.isnan(own), own)
    rows = running_before(
        rows.withColumn("_own", own), keys, levels, [F.col(trial)],
        {"_min": (real, "min"), "_pos": (F.lit(1).cast("bigint"), "sum"), "_n": (own.isNotNull().cast("bigint"), "sum"),
         "_zero": ((own == 0).cast("int"), "max")},
    )
    rows = materialize(rows, "gate")
    v = F.col("_own")
    record = (F.col("_n") == 0) | (~F.isnan(v) & (F.col("_min").isNull() | (v < F.col("_min"))))
    if threshold == 0:
        # ties move the best value, too, and against a best value of 0 every trial does
        record = record | (v <= F.col("_min")) | F.col("_min").isNull() | (F.coalesce("_zero", F.lit(0)) == 1)
    candidates = rows.filter(v.isNotNull() & record)
    base = (F.coalesce("_c_best", "baseline") * sign).alias("_base")
    candidates = candidates.select(*keys, trial, v.alias("_v"), base)
    chain = _accepted_chain(candidates, keys, trial, float(threshold)) if threshold else _accepted_fold(candidates, keys, trial)
    rows = rows.join(chain.withColumn("_moves", F.lit(True)), [*keys, trial], "left")
    pos = F.col("_pos") + 1
    last = F.when(
        F.col("_moves"), F.struct(F.col(trial).alias("t"), F.col("primary_metric").cast("double").alias("v"), pos.alias("pos"))
    )
    rows = running_before(rows, keys, levels, [F.col(trial)], {"_last": (last, "max")})
    rows = decide(rows.withColumn("best", F.coalesce("_last.v", "_c_best")), metric, direction, threshold)
    rows = rows.withColumn("_hit", F.col("_last.pos")).drop("_last", "_moves", "_min", "_n", "_own", "_zero")
    if "eval_metrics" in rows.columns:
        # trials accepted by a value under its short name end a row of rejections as well
        rows = materialize(rows.drop("_hit"), "gate")
        rows = running_before(rows, keys, levels, [F.col(trial)], {"_hit": (F.when(F.col("accepted"), pos), "max")})
    since = F.when(F.col("_hit").isNull(), pos + F.col("_c_fails")).otherwise(pos - F.col("_hit"))
    rows = rows.withColumn("fails", F.when(F.col("accepted"), 0).otherwise(since).cast("bigint"))
    rows = rows.withColumn("_pos", pos).drop("_hit", "_c_best", "_c_fails", *levels)
    if patience is None:
        return rows.withColumn("ran", F.lit(True)).drop("_pos", "_c_stop")
    stops = rows.filter(F.col("fails") >= patience).groupBy(*keys).agg(F.min("_pos").alias("_stop"))
    rows = salted_lookup(rows, stops, keys, [trial])
    ran = ~F.col("_c_stop") & F.coalesce(F.col("_pos") <= F.col("_stop"), F.lit(True))
    return rows.withColumn("ran", ran).drop("_pos", "_stop", "_c_stop")


def stop_points(gated: DataFrame, keys: Sequence[str] = ("experiment",), trial: str = "trial_id", patience: int = PATIENCE) -> DataFrame:
    """(keys, stopped_at): the trial after which an experiment was given up; null if never."""
    hit = F.when(F.col("fails") >= patience, F.col(trial))
    return gated.groupBy(*keys).agg(F.min(hit).alias("stopped_at"))


# -- history ----------------------------------------------------------------------------


def history(trials: DataFrame, n: int = 10) -> DataFrame:
    """The last n trials."""
    return trials.orderBy(F.desc("trial_id")).limit(n)


def best_trial(trials: DataFrame, direction: str = "minimize", keys: Sequence[str] = ()) -> DataFrame:
    """The best accepted trial that has a metric, overall or per key; ties go to the earliest."""
    ok = trials.filter((F.col("decision") == "accepted") & F.col("primary_metric").isNotNull())
    metric = F.asc("primary_metric") if direction == "minimize" else F.desc("primary_metric")
    if not keys:
        return ok.orderBy(metric, "trial_id").limit(1)
    # rank 1 lets every task keep one row per key before the shuffle
    w = W.partitionBy(*keys).orderBy(metric, F.col("trial_id"))
    return ok.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def accepted_trials(trials: DataFrame) -> DataFrame:
    return trials.filter(F.col("decision") == "accepted").orderBy("trial_id")


def all_trials(trials: DataFrame) -> DataFrame:
    return trials.orderBy("trial_id")


def stats(trials: DataFrame, key: str | None = None) -> DataFrame:
    """total_trials, accepted, rejected and acceptance_rate; with a key also per key, the
    overall row having a null key."""
    grouped = trials.rollup(key) if key else trials.groupBy()
    out = grouped.agg(F.count(F.lit(1)).alias("total_trials"), F.count_if(F.col("decision") == "accepted").alias("accepted"))
    return out.select(
        *([key] if key else []),
        "total_trials",
        "accepted",
        (F.col("total_trials") - F.col("accepted")).alias("rejected"),
        F.when(F.col("total_trials") > 0, F.col("accepted") / F.col("total_trials")).otherwise(0.0).alias("acceptance_rate"),
    )


def best_by_metric(trials: DataFrame, metric: str = METRIC, direction: str = "minimize") -> DataFrame:
    """The best of the trials that have any metrics; a missing metric sorts last."""
    value = F.try_element_at("metrics", F.lit(metric.replace("eval_", "")))
    worst = F.lit(float("inf") if direction == "minimize" else float("-inf"))
    order = F.coalesce(value, worst)
    have = trials.filter(F.size("metrics") > 0)
    return have.orderBy(order.asc() if direction == "minimize" else order.desc(), "trial_id").limit(1)


def recent(trials: DataFrame, n: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """The last n trials, overall or per key."""
    if not keys:
        return history(trials, n)
    w = W.partitionBy(*keys).orderBy(F.desc("trial_id"))
    return trials.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


# -- reports ----------------------------------------------------------------------------

SHOWN_TRIALS = 20
SHORT_REASON, LONG_REASON = 50, 60


def report_summary(trials: DataFrame) -> DataFrame:
    s = stats(trials)
    return s.select(
        "total_trials", "accepted", "rejected", F.concat(fixed(F.col("acceptance_rate") * 100, 1), F.lit("%")).alias("acceptance_rate")
    )


def _line(reason_length: int) -> list[Column]:
    metric = F.when(F.col("primary_metric").isNull(), "N/A").otherwise(fixed(F.col("primary_metric"), 4))
    return [
        F.col("trial_id"),
        F.col("decision"),
        metric.alias("primary_metric"),
        F.left(F.coalesce("reason", F.lit("")), F.lit(reason_length)).alias("reason"),
    ]


def report_details(trials: DataFrame, shown: int = SHOWN_TRIALS) -> DataFrame:
    return history(trials, shown).select(*_line(SHORT_REASON))


def report_listing(trials: DataFrame) -> DataFrame:
    return trials.select(*_line(LONG_REASON))


def report_best(trials: DataFrame, direction: str = "minimize") -> DataFrame:
    return best_trial(trials, direction).select("trial_id", "primary_metric", "config_hash", "reason")


def report_changes(trials: DataFrame) -> DataFrame:
    """(trial_id, line_no, line): the config changes of accepted trials."""
    lines = F.from_json("diff_json", "array<string>")
    return trials.filter(F.col("decision") == "accepted").select("trial_id", F.posexplode(lines).alias("line_no", "line"))


def total_improvement(baseline: Column, best: Column) -> Column:
    """Percent; null unless both values are there and not 0."""
    return F.when((baseline != 0) & (best != 0), F.abs(best - baseline) / F.abs(baseline) * 100)


def final_summary(gated: DataFrame, baselines: DataFrame, keys: Sequence[str] = ("experiment",), direction: str = "minimize") -> DataFrame:
    """Counts, baseline, best value reached and total improvement per experiment."""
    kept = F.when(F.col("accepted"), F.col("primary_metric").cast("double"))
    top = F.min(kept) if direction == "minimize" else F.max(kept)
    out = gated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trials"), F.count_if(F.col("accepted")).alias("accepted"), top.alias("_top")
    )
    out = out.join(baselines, list(keys), "left").withColumn("best", F.coalesce("_top", "baseline"))
    return out.select(
        *keys, "trials", "accepted", "baseline", "best", total_improvement(F.col("baseline"), F.col("best")).alias("improvement_pct")
    )


def phase(trial_number: Column, exploration_trials: int = EXPLORATION_TRIALS) -> Column:
    return F.when(trial_number <= exploration_trials, "EXPLORATION").otherwise("EXPLOITATION")


def resume_point(trials: DataFrame, keys: Sequence[str] = ("experiment",), direction: str = "minimize") -> DataFrame:
    """Per experiment: the next trial's number and the values to go on with. The baseline is
    the record with trial id -1."""
    done = F.col("trial_id") >= 0
    kept = F.when(done & (F.col("decision") == "accepted"), F.col("primary_metric"))
    top = F.min(kept) if direction == "minimize" else F.max(kept)
    base = F.max(F.when(~done, F.col("primary_metric")))
    return trials.groupBy(*keys).agg(
        F.count_if(done).alias("next_trial"), base.alias("baseline"), F.coalesce(top, base).alias("best")
    )


def remaining(candidates: DataFrame, trials: DataFrame, config_hash: str = "config_hash") -> DataFrame:
    """Candidates whose config has not been tried yet."""
    return candidates.join(trials.select(config_hash).distinct(), config_hash, "left_anti")


def seed_variation_stats(trials: DataFrame, keys: Sequence[str] = ("config_hash",)) -> DataFrame:
    return trials.groupBy(*keys).agg(
        F.count("primary_metric").alias("n"), F.avg("primary_metric").alias("mean"), F.stddev_samp("primary_metric").alias("std")
    )
