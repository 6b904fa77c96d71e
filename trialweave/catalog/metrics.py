"""Registered queries: evaluation metrics and metric series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.draws import u
from ..functions.texts import words
from ..operators import metrics as M
from ..operators.prepare import assign_batches
from ..plans.ordered import number_rows, time_levels
from ..plans.session import materialize
from ..sources.tables import table
from .kit import u_sql, words_sql

QUERIES, SQL = {}, {}


def series(spark, d):
    """Metric series from the event stream: run = event type, step = position in time."""
    e = table(spark, d, "events", "event_id", "ts", "event_type", "value")
    steps = number_rows(e, ["event_type"], time_levels(F.col("ts")), [F.col("ts"), F.col("event_id")], "step")
    return steps.select(F.col("event_type").alias("run"), "step", "value")


def stored_series(spark, d):
    """The series as a table of its own, for operators that read it several times."""
    return materialize(series(spark, d), "series")


SERIES_CTE = (
    "s AS (SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)::BIGINT AS step, value FROM events)"
)


def predictions(spark, d):
    """Labels with a wrong prediction in a tenth of the rows, a loss and evaluation batches of 16."""
    labels = table(spark, d, "labels", "doc_id", "quality")
    k = F.col("doc_id")
    rows = labels.select(
        "doc_id",
        F.col("quality").alias("label"),
        F.when(u(42, "pred", k, 0) < 0.1, 1 - F.col("quality")).otherwise(F.col("quality")).alias("pred"),
        (-F.log(u(42, "loss", k, 0) * 0.98 + 0.01)).alias("loss"),
    )
    return assign_batches(rows, "doc_id", 16, shuffle=False, drop_last=False)


PRED_CTE = f"""p AS (SELECT doc_id, quality AS label, CASE WHEN {u_sql(42, 'pred', 'doc_id', 0)} < 0.1::DOUBLE THEN 1 - quality ELSE quality END AS pred,
 -ln({u_sql(42, 'loss', 'doc_id', 0)} * 0.98::DOUBLE + 0.01::DOUBLE) AS loss, ((row_number() OVER (ORDER BY doc_id) - 1) // 16)::BIGINT AS batch_id FROM labels)"""


def g1_eval_loss(spark, d):
    p = predictions(spark, d)
    b = M.eval_loss(p).select(F.lit("batch").alias("weighting"), F.round("loss", 6).alias("loss"))
    s = M.eval_loss(p, weighting="sample").select(F.lit("sample").alias("weighting"), F.round("loss", 6).alias("loss"))
    return b.unionByName(s)


QUERIES["g1_eval_loss"] = g1_eval_loss
SQL["g1_eval_loss"] = f"""WITH {PRED_CTE}
SELECT 'batch' AS weighting, round(avg(l), 6) AS loss FROM (SELECT avg(loss) AS l FROM p GROUP BY batch_id)
UNION ALL SELECT 'sample', round(avg(loss), 6) FROM p"""


def g2_accuracy(spark, d):
    return M.accuracy(predictions(spark, d)).withColumn("accuracy", F.round("accuracy", 6))


QUERIES["g2_accuracy"] = g2_accuracy
SQL["g2_accuracy"] = f"WITH {PRED_CTE} SELECT count(*)::BIGINT AS samples, round(sum((pred = label)::INT) / count(*)::DOUBLE, 6) AS accuracy FROM p"


def g3_token_accuracy(spark, d):
    """Stand-in predictions of the next word's length; words above 12 letters are ignored labels."""
    docs = table(spark, d, "documents", "doc_id", "text", many_tasks=True)
    labels = F.transform(words(F.col("text")), lambda w: F.when(F.length(w) > 12, M.IGNORE_LABEL).otherwise(F.length(w)))
    rows = docs.select("doc_id", labels.alias("labels"))
    pred = F.transform(
        "labels",
        lambda x, i: F.when(u(42, "next", F.col("doc_id"), i) < 0.1, 0).otherwise(F.coalesce(F.get("labels", i + 1), F.lit(0))),
    )
    return M.token_accuracy(rows.withColumn("pred", pred)).withColumn("accuracy", F.round("accuracy", 6))


QUERIES["g3_token_accuracy"] = g3_token_accuracy
SQL["g3_token_accuracy"] = f"""
WITH w AS (SELECT doc_id, list_transform({words_sql('text')}, lambda w: CASE WHEN length(w) > 12 THEN -100 ELSE length(w) END) AS labels FROM documents),
t AS (SELECT doc_id, unnest(labels[2:len(labels)]) AS label, generate_subscripts(labels[2:len(labels)], 1) - 1 AS i FROM w),
m AS (SELECT label, CASE WHEN {u_sql(42, 'next', 'doc_id', 'i')} < 0.1::DOUBLE THEN 0 ELSE label END AS pred FROM t WHERE label <> -100)
SELECT count(*)::BIGINT AS tokens, round(sum((pred = label)::INT) / count(*)::DOUBLE, 6) AS accuracy FROM m
"""


def g4_perplexity(spark, d):
    return series(spark, d).select(
        "run", "step", F.round(M.perplexity(F.col("value") / 100), 6).alias("perplexity"),
        M.perplexity(F.col("value") + 1000).alias("overflow"),
    )


QUERIES["g4_perplexity"] = g4_perplexity
SQL["g4_perplexity"] = f"WITH {SERIES_CTE} SELECT run, step, round(exp(value / 100), 6) AS perplexity, 'Infinity'::DOUBLE AS overflow FROM s"


def g5_bits_per_byte(spark, d):
    return series(spark, d).select("run", "step", F.round(M.bits_per_byte(F.col("value")), 6).alias("bpb"))


QUERIES["g5_bits_per_byte"] = g5_bits_per_byte
SQL["g5_bits_per_byte"] = f"WITH {SERIES_CTE} SELECT run, step, round(value * 1.4426950408889634::DOUBLE / 4.0::DOUBLE, 6) AS bpb FROM s"


def g6_max_eval_steps(spark, d):
    return M.eval_loss(M.limit_batches(predictions(spark, d), 5)).withColumn("loss", F.round("loss", 6))


QUERIES["g6_max_eval_steps"] = g6_max_eval_steps
SQL["g6_max_eval_steps"] = f"WITH {PRED_CTE} SELECT round(avg(l), 6) AS loss FROM (SELECT avg(loss) AS l FROM p WHERE batch_id < 5 GROUP BY batch_id)"


def g7_improved(spark, d):
    s = stored_series(spark, d)
    low = M.improved(s).withColumn("direction", F.lit("minimize"))
    return low.unionByName(M.improved(s, direction="maximize").withColumn("direction", F.lit("maximize")))


QUERIES["g7_improved"] = g7_improved
_prev = "OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
SQL["g7_improved"] = f"""WITH {SERIES_CTE}
SELECT run, step, value, coalesce(value < min(value) {_prev}, true) AS improved, 'minimize' AS direction FROM s
UNION ALL SELECT run, step, value, coalesce(value > max(value) {_prev}, true), 'maximize' FROM s"""


def nan_series(spark, d):
    """The series with NaN at every seventh step, and one run that starts with it."""
    s = stored_series(spark, d)
    bad = (F.col("step") % 7 == 0) | ((F.col("step") == 1) & (F.col("run") == "click"))
    return s.withColumn("value", F.when(bad, float("nan")).otherwise(F.col("value")))


NAN_CTE = f"""{SERIES_CTE}, q AS (SELECT run, step, (step % 7 = 0) OR (step = 1 AND run = 'click') AS bad, value FROM s),
f AS (SELECT *, bool_or(bad AND step = 1) OVER (PARTITION BY run) AS stuck FROM q)"""


def g7_improved_nan(spark, d):
    return M.improved(nan_series(spark, d)).select("run", "step", "improved")


QUERIES["g7_improved_nan"] = g7_improved_nan
SQL["g7_improved_nan"] = f"""WITH {NAN_CTE}
SELECT run, step, step = 1 OR (NOT stuck AND NOT bad AND coalesce(value < min(CASE WHEN NOT bad THEN value END) {_prev}, true)) AS improved FROM f"""


def g8_latest(spark, d):
    return M.latest(series(spark, d))


QUERIES["g8_latest"] = g8_latest
SQL["g8_latest"] = f"WITH {SERIES_CTE} SELECT run, max_by(value, step) AS latest FROM s GROUP BY run"


def g9_best(spark, d):
    s = stored_series(spark, d)
    return M.best(s).withColumn("direction", F.lit("minimize")).unionByName(
        M.best(s, direction="maximize").withColumn("direction", F.lit("maximize"))
    )


QUERIES["g9_best"] = g9_best
SQL["g9_best"] = f"""WITH {SERIES_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY value, step) AS lo, row_number() OVER (PARTITION BY run ORDER BY value DESC, step) AS hi FROM s)
SELECT run, value AS best, step AS best_step, 'minimize' AS direction FROM r WHERE lo = 1
UNION ALL SELECT run, value, step, 'maximize' FROM r WHERE hi = 1"""


def g9_best_nan(spark, d):
    b = M.best(nan_series(spark, d))
    return b.select("run", "best_step", F.isnan("best").alias("best_is_nan"))


QUERIES["g9_best_nan"] = g9_best_nan
SQL["g9_best_nan"] = f"""WITH {NAN_CTE}
SELECT run, CASE WHEN any_value(stuck) THEN 1 ELSE arg_min(step, struct_pack(v := value, s := step)) FILTER (NOT bad) END::BIGINT AS best_step,
 any_value(stuck) AS best_is_nan FROM f GROUP BY run"""


def g10_running_average(spark, d):
    return M.running_average(stored_series(spark, d)).select("run", "step", F.round("running_avg", 6).alias("running_avg"))


QUERIES["g10_running_average"] = g10_running_average
SQL["g10_running_average"] = f"""WITH {SERIES_CTE}
SELECT run, step, round(avg(value) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS running_avg FROM s"""


def g11_metric_summary(spark, d):
    return M.metric_summary(stored_series(spark, d)).withColumn("avg_last_10", F.round("avg_last_10", 6))


QUERIES["g11_metric_summary"] = g11_metric_summary
SQL["g11_metric_summary"] = f"""WITH {SERIES_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS rn FROM s)
SELECT run, max_by(value, step) AS latest, min(value) AS best, arg_min(step, struct_pack(v := value, s := step)) AS best_step,
 round(avg(value) FILTER (rn <= 10), 6) AS avg_last_10, count(*)::BIGINT AS n_values FROM r GROUP BY run"""


def g12_primary_metric(spark, d):
    """One row per event as a finished run; every third one lacks the evaluation entry."""
    e = table(spark, d, "events", "event_id", "user_id", "value")
    have = F.when(F.col("event_id") % 3 > 0, F.create_map(F.lit("loss"), F.col("value"))).otherwise(
        F.create_map(F.lit("accuracy"), F.col("value"))
    )
    train = F.col("user_id").cast("double")
    return e.select(
        "event_id",
        M.primary_metric("eval_loss", have, train).alias("eval_loss"),
        M.primary_metric("train_loss", have, train).alias("train_loss"),
    )


QUERIES["g12_primary_metric"] = g12_primary_metric
SQL["g12_primary_metric"] = (
    "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN value ELSE user_id::DOUBLE END AS eval_loss, user_id::DOUBLE AS train_loss FROM events"
)


def g13_eval_points(spark, d):
    return M.eval_points(series(spark, d), 100)


QUERIES["g13_eval_points"] = g13_eval_points
SQL["g13_eval_points"] = f"WITH {SERIES_CTE} SELECT run, step, value FROM s WHERE step % 100 = 0"
