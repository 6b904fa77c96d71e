"""Registered queries: the streaming operators, fed by the stored tables as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.text_augment import TextAugmenter
from ..plans.session import fresh_path
from ..sources.tables import table
from ..streaming import jobs as K
from .safety import findings_sql
from .text import AUGMENTED_SQL, COLUMN_CONFIG
from .trials import decide_sql, event_baselines, gate_cte

QUERIES, SQL = {}, {}


def table_stream(spark, d, name):
    """A stored table, which is one file or a folder of files, as a stream of its files.

    A stream's path must be a folder or a pattern; the pattern here matches the table alone, whichever of the two it is.
    """
    schema = spark.read.parquet(f"{d}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{d}/{name}.parque[t]")


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _series(spark, d):
    e = table_stream(spark, d, "events")
    return e.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), "value")


def k1_stream_metric_tracker(spark, d):
    path = fresh_path(spark, "tracker")
    _finish(K.stream_metric_tracker(_series(spark, d), path))
    return K.tracker_flags(spark, path)


QUERIES["k1_stream_metric_tracker"] = k1_stream_metric_tracker
_prev = "OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
SQL["k1_stream_metric_tracker"] = (
    f"SELECT event_type AS run, event_id AS step, value, coalesce(value < min(value) {_prev}, true) AS improved FROM events"
)


def k1_stream_metric_summary(spark, d):
    path = fresh_path(spark, "tracker")
    _finish(K.stream_metric_tracker(_series(spark, d), path, direction="maximize"))
    s = K.tracker_summary(spark, path)
    return s.withColumn("avg_last_10", F.round("avg_last_10", 6))


QUERIES["k1_stream_metric_summary"] = k1_stream_metric_summary
SQL["k1_stream_metric_summary"] = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
SELECT event_type AS run, max_by(value, event_id) AS latest, max(value) AS best, arg_min(event_id, struct_pack(v := -value, s := event_id)) AS best_step,
 round(avg(value) FILTER (rn <= 10), 6) AS avg_last_10, count(*)::BIGINT AS n_values FROM r GROUP BY event_type"""


def k2_stream_trial_gate(spark, d):
    e = table_stream(spark, d, "events")
    i = F.col("event_id")
    trials = e.select(
        F.col("user_id").alias("experiment"),
        i.alias("trial_id"),
        F.when(i % 29 == 0, "exception").when(i % 17 == 0, "error").alias("status"),
        F.when(i % 34 == 0, "OOM").alias("error"),
        F.when(i % 13 != 0, F.col("value")).alias("primary_metric"),
        F.when(i % 26 == 0, F.create_map(F.lit("loss"), F.col("value"))).alias("eval_metrics"),
        (i % 11 != 0).alias("safe"),
    )
    path = fresh_path(spark, "stream-gate")
    _finish(K.stream_trial_gate(trials, path, baselines=event_baselines(spark, d)))
    return K.gate_decisions(spark, path).drop("primary_metric")


QUERIES["k2_stream_trial_gate"] = k2_stream_trial_gate
_by_event = gate_cte().replace("(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS trial_id", "event_id AS trial_id")
SQL["k2_stream_trial_gate"] = (
    f"WITH RECURSIVE {_by_event} SELECT experiment, trial_id, best, hit AS accepted, fails, ran, reason, improvement FROM {decide_sql('z')}"
)


def k3_stream_augment(spark, d):
    path = fresh_path(spark, "augmented")
    docs = table_stream(spark, d, "documents").select("doc_id", "text")
    _finish(K.stream_augment(docs, TextAugmenter(COLUMN_CONFIG), path))
    return spark.read.parquet(f"{path}/data").select("doc_id", F.md5("text").alias("text_md5"))


QUERIES["k3_stream_augment"] = k3_stream_augment
SQL["k3_stream_augment"] = f"SELECT doc_id, md5(text) AS text_md5 FROM {AUGMENTED_SQL}"


def k4_stream_safety(spark, d):
    path = fresh_path(spark, "screened")
    docs = table_stream(spark, d, "documents").select("doc_id", "text")
    _finish(K.stream_safety(docs, path))
    out = spark.read.parquet(f"{path}/data")
    return out.select("doc_id", "status", F.size("findings").cast("bigint").alias("n"), F.md5("text").alias("text_md5"))


QUERIES["k4_stream_safety"] = k4_stream_safety
SQL["k4_stream_safety"] = f"""
WITH f AS (SELECT doc_id, count(*)::BIGINT AS n FROM {findings_sql('documents')} GROUP BY doc_id)
SELECT doc_id, CASE WHEN f.n IS NULL THEN 'clean' ELSE 'quarantine' END AS status, coalesce(f.n, 0) AS n, md5(text) AS text_md5 FROM documents LEFT JOIN f USING (doc_id)"""


def _run_log(spark, d):
    """Every user is a run; errors with an event id divisible by 7 end it."""
    e = table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")
    end = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)
    rows = e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run"),
        F.when(end, "end").otherwise("metric").alias("kind"),
        F.col("event_id").alias("step"),
        F.when(~end, F.col("event_type")).alias("metric"),
        F.when(~end, F.col("value")).alias("value"),
        F.when(end, F.col("value") < 10).alias("accepted"),
        F.when(end, F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("reason"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("at"),
    )
    incoming, path = fresh_path(spark, "run-events"), fresh_path(spark, "run-log")
    rows.write.json(incoming)
    _finish(K.stream_run_log(K.read_run_events(spark, incoming), path))
    return K.run_log(spark, path)


def k5_stream_run_log(spark, d):
    return _run_log(spark, d)[1]


QUERIES["k5_stream_run_log"] = k5_stream_run_log
_end = "(event_type = 'error' AND event_id % 7 = 0)"
SQL["k5_stream_run_log"] = f"""
SELECT 'run-' || user_id AS run, bool_or({_end}) AS closed, arg_max(value < 10, event_id) FILTER ({_end}) AS accepted,
 'event ' || (max(event_id) FILTER ({_end})) AS reason, lpad((max(event_id) FILTER ({_end}))::VARCHAR, 12, '0') AS ended_at,
 count(*) FILTER (NOT {_end})::BIGINT AS points FROM events GROUP BY user_id"""


def k5_stream_run_metrics(spark, d):
    return _run_log(spark, d)[0]


QUERIES["k5_stream_run_metrics"] = k5_stream_run_metrics
SQL["k5_stream_run_metrics"] = f"SELECT 'run-' || user_id AS run, event_id AS step, event_type AS metric, value FROM events WHERE NOT {_end}"


# fixed value: how long a run may be silent
SILENCE = "2 hours"


def k5_stream_run_timeouts(spark, d):
    """Users are runs; errors with an event id divisible by 7 end them, and so does a silence that the stream has gone on for."""
    e = table_stream(spark, d, "events")
    end = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)
    rows = e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run"), F.when(end, "end").otherwise("metric").alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"), F.when(end, F.col("value") < 10).alias("accepted"), F.when(end, F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("reason"),
    )
    path = fresh_path(spark, "run-ends")
    _finish(K.stream_run_ends(rows, path, timeout=SILENCE))
    out = spark.read.parquet(f"{path}/data")
    return out.select("run", "closed_by", "accepted", "reason", F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("ended_at"), "points")


QUERIES["k5_stream_run_timeouts"] = k5_stream_run_timeouts
SQL["k5_stream_run_timeouts"] = f"""
WITH r AS (SELECT 'run-' || user_id AS run, max(struct_pack(ts := date_trunc('millisecond', ts), reason := 'event ' || event_id, accepted := value < 10)) FILTER ({_end}) AS e,
 date_trunc('millisecond', max(ts)) AS last, count(*) FILTER (NOT {_end})::BIGINT AS points FROM events GROUP BY user_id)
SELECT run, CASE WHEN e IS NULL THEN 'timeout' ELSE 'end' END AS closed_by, e.accepted AS accepted, e.reason AS reason,
 strftime(CASE WHEN e IS NULL THEN last + INTERVAL {SILENCE} ELSE e.ts END, '%Y-%m-%d %H:%M:%S.%g') AS ended_at, points
FROM r WHERE e IS NOT NULL OR last + INTERVAL {SILENCE} < (SELECT date_trunc('millisecond', max(ts)) FROM events)"""
