"""Registered queries: trial decisions, the gate, history and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trials as H
from ..plans.ordered import number_rows, time_levels
from ..sources.tables import table

QUERIES, SQL = {}, {}


def event_trials(spark, d):
    """Events as trials: experiment = user, in time order, with failed, unsafe, metric-less
    and raising trials in between."""
    e = table(spark, d, "events", "event_id", "ts", "user_id", "value")
    n = number_rows(e, ["user_id"], time_levels(F.col("ts")), [F.col("ts"), F.col("event_id")], "_n")
    i = F.col("event_id")
    missing = i % 13 == 0
    return n.select(
        F.col("user_id").alias("experiment"),
        (F.col("_n") - 1).alias("trial_id"),
        i.alias("event_id"),
        F.when(i % 29 == 0, "exception").when(i % 17 == 0, "error").alias("status"),
        F.when(i % 34 == 0, "OOM").alias("error"),
        F.when(~missing, F.col("value")).alias("primary_metric"),
        F.when(i % 26 == 0, F.create_map(F.lit("loss"), F.col("value"))).alias("eval_metrics"),
        (i % 11 != 0).alias("safe"),
    )


def event_baselines(spark, d):
    """Every third experiment starts without a baseline."""
    e = table(spark, d, "events", "user_id", "value").filter("user_id % 3 <> 0")
    return e.groupBy(F.col("user_id").alias("experiment")).agg(F.round(F.avg("value"), 3).alias("baseline"))


TRIALS_CTE = """
t AS (SELECT user_id AS experiment, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS trial_id,
  CASE WHEN event_id % 29 = 0 THEN 'exception' WHEN event_id % 17 = 0 THEN 'error' END AS status,
  CASE WHEN event_id % 34 = 0 THEN 'OOM' END AS error,
  CASE WHEN event_id % 13 <> 0 THEN value END AS primary_metric, CASE WHEN event_id % 26 = 0 THEN value END AS short_metric,
  event_id % 11 <> 0 AS safe FROM events),
b AS (SELECT user_id AS experiment, round(avg(value), 3) AS baseline FROM events WHERE user_id % 3 <> 0 GROUP BY user_id)"""


def _gain(direction: str, cur: str, ref: str) -> str:
    top = f"{ref} - {cur}" if direction == "minimize" else f"{cur} - {ref}"
    return f"(CASE WHEN {ref} = 0 THEN 0.0::DOUBLE ELSE ({top}) / abs({ref}) END)"


def h1_improvement(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_custkey")
    ref = (F.col("o_custkey") % 50 * 10000).cast("double")
    return o.select(
        "o_orderkey",
        H.improvement(F.col("o_totalprice"), ref).alias("down"),
        H.improvement(F.col("o_totalprice"), ref, "maximize").alias("up"),
    )


QUERIES["h1_improvement"] = h1_improvement
_ref = "(o_custkey % 50 * 10000)::DOUBLE"
SQL["h1_improvement"] = (
    f"SELECT o_orderkey, {_gain('minimize', 'o_totalprice', _ref)} AS down, {_gain('maximize', 'o_totalprice', _ref)} AS up FROM orders"
)

METRIC_VALUE = "coalesce(primary_metric, short_metric)"


def decide_sql(src: str, direction: str = "minimize") -> str:
    """Adds accepted, improvement, reason to rows with baseline and best."""
    gain = _gain(direction, METRIC_VALUE, "coalesce(best, baseline)")
    return f"""(SELECT * EXCLUDE (g, judged), judged AND (ref IS NULL OR g >= 0.005::DOUBLE) AS accepted,
 CASE WHEN judged AND ref IS NOT NULL THEN g ELSE 0.0::DOUBLE END AS improvement,
 CASE WHEN status = 'error' THEN 'Trial failed: ' || coalesce(error, 'unknown error')
  WHEN v IS NULL THEN 'Primary metric ''eval_loss'' not found in results'
  WHEN NOT safe THEN 'Safety checks failed (PII detected or license incompatible)'
  WHEN ref IS NULL THEN 'First trial — accepted as initial baseline'
  WHEN g >= 0.005::DOUBLE THEN printf('Improved eval_loss by %.4f (%.2f%%) over %s (%.4f → %.4f)', g, g * 100, CASE WHEN best IS NOT NULL THEN 'best' ELSE 'baseline' END, ref, v)
  ELSE printf('Insufficient improvement: %.4f (%.2f%%) < threshold 0.50%% (current: %.4f, best: %.4f)', g, g * 100, v, ref) END AS reason
 FROM (SELECT *, {METRIC_VALUE} AS v, coalesce(best, baseline) AS ref, {gain} AS g,
   coalesce(status <> 'error', true) AND {METRIC_VALUE} IS NOT NULL AND safe AS judged FROM {src}))"""


def _referenced(spark, d):
    """Every trial with a fixed pair of references, absent in some."""
    t = event_trials(spark, d).filter("status is null or status <> 'exception'")
    i = F.col("event_id")
    return t.withColumn("baseline", F.when(i % 5 != 0, (i % 40).cast("double"))).withColumn(
        "best", F.when(i % 3 != 0, (i % 30).cast("double"))
    )


REF_SQL = """(SELECT *, CASE WHEN event_id % 5 <> 0 THEN (event_id % 40)::DOUBLE END AS baseline,
 CASE WHEN event_id % 3 <> 0 THEN (event_id % 30)::DOUBLE END AS best FROM t WHERE coalesce(status, '') <> 'exception')"""


def h2_decide(spark, d):
    return H.decide(_referenced(spark, d)).select(
        "experiment", "trial_id", "accepted", "improvement", "reason"
    )


QUERIES["h2_decide"] = h2_decide
SQL["h2_decide"] = f"WITH {TRIALS_CTE} SELECT experiment, trial_id, accepted, improvement, reason FROM {decide_sql(REF_SQL)}"


def gated(spark, d, **kw):
    return H.sequential_gate(event_trials(spark, d), baselines=event_baselines(spark, d), **kw)


def gate_cte(direction: str = "minimize", patience: int = 10, threshold: float = 0.005) -> str:
    """The fold, one trial after the other, as a recursive query."""
    gain = _gain(direction, "n.v", "coalesce(g.best, n.baseline)")
    hit = f"(n.judged AND (coalesce(g.best, n.baseline) IS NULL OR {gain} >= {threshold}::DOUBLE))"
    return f"""{TRIALS_CTE},
r AS (SELECT t.*, b.baseline, {METRIC_VALUE} AS v, coalesce(status <> 'error', true) AND {METRIC_VALUE} IS NOT NULL AND safe AS judged,
  row_number() OVER (PARTITION BY experiment ORDER BY trial_id) AS pos FROM t LEFT JOIN b USING (experiment) WHERE coalesce(status, '') <> 'exception'),
g AS (SELECT experiment, 0::BIGINT AS pos, NULL::DOUBLE AS best, NULL::DOUBLE AS held, 0::BIGINT AS fails, false AS accepted FROM (SELECT DISTINCT experiment FROM r)
 UNION ALL SELECT n.experiment, n.pos, CASE WHEN {hit} THEN coalesce(n.primary_metric, g.best) ELSE g.best END, g.best,
   CASE WHEN {hit} THEN 0 ELSE g.fails + 1 END, {hit}
 FROM g JOIN r n ON n.experiment = g.experiment AND n.pos = g.pos + 1),
st AS (SELECT experiment, min(pos) AS stop FROM g WHERE fails >= {patience} GROUP BY experiment),
z AS (SELECT r.* EXCLUDE (v, judged), g.held AS best, g.fails, g.accepted AS hit, coalesce(r.pos <= st.stop, true) AS ran
  FROM r JOIN g USING (experiment, pos) LEFT JOIN st ON st.experiment = r.experiment)"""


GATE_COLUMNS = ["experiment", "trial_id", "best", "accepted", "fails", "ran", "reason"]


def h3_sequential_gate(spark, d):
    return gated(spark, d).select(*GATE_COLUMNS, "improvement")


QUERIES["h3_sequential_gate"] = h3_sequential_gate
SQL["h3_sequential_gate"] = (
    f"WITH RECURSIVE {gate_cte()} SELECT experiment, trial_id, best, hit AS accepted, fails, ran, reason, improvement FROM {decide_sql('z')}"
)


def h3_sequential_gate_maximize(spark, d):
    return gated(spark, d, direction="maximize", patience=25).select("experiment", "trial_id", "best", "accepted", "fails", "ran")


QUERIES["h3_sequential_gate_maximize"] = h3_sequential_gate_maximize
SQL["h3_sequential_gate_maximize"] = (
    f"WITH RECURSIVE {gate_cte('maximize', 25)} SELECT experiment, trial_id, best, hit AS accepted, fails, ran FROM z"
)


def h3_sequential_gate_ties(spark, d):
    """Without a threshold, a trial as good as the best moves it."""
    return gated(spark, d, threshold=0).select("experiment", "trial_id", "best", "accepted", "fails", "ran")


QUERIES["h3_sequential_gate_ties"] = h3_sequential_gate_ties
SQL["h3_sequential_gate_ties"] = (
    f"WITH RECURSIVE {gate_cte(threshold=0.0)} SELECT experiment, trial_id, best, hit AS accepted, fails, ran FROM z"
)


def h4_early_stop(spark, d):
    return H.stop_points(gated(spark, d))


QUERIES["h4_early_stop"] = h4_early_stop
SQL["h4_early_stop"] = (
    f"WITH RECURSIVE {gate_cte()} SELECT experiment, min(trial_id) FILTER (fails >= 10) AS stopped_at FROM z GROUP BY experiment"
)

# -- history: orders as a log of decided trials -------------------------------------------


def order_trials(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    diff = F.when(k % 7 == 0, "not json").otherwise(
        F.to_json(F.array(F.concat(F.lit("  batch: 8 → "), F.col("o_custkey").cast("string")), F.concat(F.lit("+ seed: "), k.cast("string"))))
    )
    return o.select(
        k.alias("trial_id"),
        (F.col("o_custkey") % 50).alias("experiment"),
        F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("decision"),
        F.when(k % 19 != 0, price).alias("primary_metric"),
        F.concat(F.lit("h"), (F.col("o_custkey") % 97).cast("string")).alias("config_hash"),
        F.when(k % 5 != 0, F.concat(F.lit("priority of this order is "), F.col("o_orderpriority"), F.lit(", the trial was decided by its status"))).alias("reason"),
        diff.alias("diff_json"),
        F.when(k % 4 == 0, F.create_map()).when(k % 4 == 1, F.create_map(F.lit("accuracy"), price)).otherwise(F.create_map(F.lit("loss"), price))
        .cast("map<string,double>").alias("metrics"),
    )


OT = """ot AS (SELECT o_orderkey AS trial_id, o_custkey % 50 AS experiment, CASE WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS decision,
  CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS primary_metric, 'h' || (o_custkey % 97) AS config_hash,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'priority of this order is ' || o_orderpriority || ', the trial was decided by its status' END AS reason,
  o_orderkey % 7 <> 0 AS json_ok, '  batch: 8 → ' || o_custkey AS line0, '+ seed: ' || o_orderkey AS line1, o_totalprice AS price FROM orders)"""
LOG = ["trial_id", "experiment", "decision", "primary_metric", "config_hash", "reason"]
LOG_SQL = ", ".join(LOG)


def h5_history(spark, d):
    return H.history(order_trials(spark, d)).select(*LOG)


QUERIES["h5_history"] = h5_history
SQL["h5_history"] = f"WITH {OT} SELECT {LOG_SQL} FROM ot ORDER BY trial_id DESC LIMIT 10"


def h6_best(spark, d):
    t = order_trials(spark, d)
    low = H.best_trial(t).select(F.lit("overall").alias("kind"), *LOG)
    high = H.best_trial(t, "maximize").select(F.lit("overall_max").alias("kind"), *LOG)
    return low.unionByName(high).unionByName(H.best_trial(t, keys=("experiment",)).select(F.lit("experiment").alias("kind"), *LOG))


QUERIES["h6_best"] = h6_best
_ok = "decision = 'accepted' AND primary_metric IS NOT NULL"
SQL["h6_best"] = f"""WITH {OT}, k AS (SELECT *, row_number() OVER (ORDER BY primary_metric, trial_id) AS a, row_number() OVER (ORDER BY primary_metric DESC, trial_id) AS z,
 row_number() OVER (PARTITION BY experiment ORDER BY primary_metric, trial_id) AS e FROM ot WHERE {_ok})
SELECT 'overall' AS kind, {LOG_SQL} FROM k WHERE a = 1 UNION ALL SELECT 'overall_max', {LOG_SQL} FROM k WHERE z = 1
UNION ALL SELECT 'experiment', {LOG_SQL} FROM k WHERE e = 1"""


def h7_accepted(spark, d):
    return H.accepted_trials(order_trials(spark, d)).select(*LOG)


QUERIES["h7_accepted"] = h7_accepted
SQL["h7_accepted"] = f"WITH {OT} SELECT {LOG_SQL} FROM ot WHERE decision = 'accepted' ORDER BY trial_id"


def h8_all_trials(spark, d):
    return H.all_trials(order_trials(spark, d)).select(*LOG)


QUERIES["h8_all_trials"] = h8_all_trials
SQL["h8_all_trials"] = f"WITH {OT} SELECT {LOG_SQL} FROM ot ORDER BY trial_id"


def h9_stats(spark, d):
    return H.stats(order_trials(spark, d), "experiment").withColumn("acceptance_rate", F.round("acceptance_rate", 6))


QUERIES["h9_stats"] = h9_stats
SQL["h9_stats"] = f"""WITH {OT} SELECT experiment, count(*)::BIGINT AS total_trials, count(*) FILTER (decision = 'accepted')::BIGINT AS accepted,
 count(*) FILTER (decision <> 'accepted')::BIGINT AS rejected, round(count(*) FILTER (decision = 'accepted') / count(*)::DOUBLE, 6) AS acceptance_rate
 FROM ot GROUP BY ROLLUP (experiment)"""


def h10_best_by_metric(spark, d):
    t = order_trials(spark, d)
    low = H.best_by_metric(t).withColumn("kind", F.lit("loss"))
    return low.unionByName(H.best_by_metric(t, "eval_accuracy", "maximize").withColumn("kind", F.lit("accuracy"))).select("kind", *LOG)


QUERIES["h10_best_by_metric"] = h10_best_by_metric
SQL["h10_best_by_metric"] = f"""WITH {OT}
(SELECT 'loss' AS kind, {LOG_SQL} FROM ot WHERE trial_id % 4 <> 0 ORDER BY CASE WHEN trial_id % 4 > 1 THEN price ELSE 'inf'::DOUBLE END, trial_id LIMIT 1)
UNION ALL (SELECT 'accuracy', {LOG_SQL} FROM ot WHERE trial_id % 4 <> 0 ORDER BY CASE WHEN trial_id % 4 = 1 THEN price ELSE '-inf'::DOUBLE END DESC, trial_id LIMIT 1)"""


def h11_recent(spark, d):
    return H.recent(order_trials(spark, d), 5, ("experiment",)).select(*LOG)


QUERIES["h11_recent"] = h11_recent
SQL["h11_recent"] = f"WITH {OT} SELECT {LOG_SQL} FROM ot QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY trial_id DESC) <= 5"


def h12_report_summary(spark, d):
    return H.report_summary(order_trials(spark, d))


QUERIES["h12_report_summary"] = h12_report_summary
SQL["h12_report_summary"] = f"""WITH {OT}, s AS (SELECT count(*)::BIGINT AS n, count(*) FILTER (decision = 'accepted')::BIGINT AS a FROM ot)
SELECT n AS total_trials, a AS accepted, n - a AS rejected, printf('%.1f%%', a / n::DOUBLE * 100) AS acceptance_rate FROM s"""

_metric = "CASE WHEN primary_metric IS NULL THEN 'N/A' ELSE printf('%.4f', primary_metric) END AS primary_metric"


def h12_report_details(spark, d):
    return H.report_details(order_trials(spark, d))


QUERIES["h12_report_details"] = h12_report_details
SQL["h12_report_details"] = (
    f"WITH {OT} SELECT trial_id, decision, {_metric}, left(coalesce(reason, ''), 50) AS reason FROM ot ORDER BY trial_id DESC LIMIT 20"
)


def h12_report_listing(spark, d):
    return H.report_listing(order_trials(spark, d))


QUERIES["h12_report_listing"] = h12_report_listing
SQL["h12_report_listing"] = f"WITH {OT} SELECT trial_id, decision, {_metric}, left(coalesce(reason, ''), 60) AS reason FROM ot"


def h12_report_best(spark, d):
    return H.report_best(order_trials(spark, d))


QUERIES["h12_report_best"] = h12_report_best
SQL["h12_report_best"] = f"WITH {OT} SELECT trial_id, primary_metric, config_hash, reason FROM ot WHERE {_ok} ORDER BY primary_metric, trial_id LIMIT 1"


def h12_report_changes(spark, d):
    return H.report_changes(order_trials(spark, d))


QUERIES["h12_report_changes"] = h12_report_changes
SQL["h12_report_changes"] = f"""WITH {OT} SELECT trial_id, 0 AS line_no, line0 AS line FROM ot WHERE decision = 'accepted' AND json_ok
UNION ALL SELECT trial_id, 1, line1 FROM ot WHERE decision = 'accepted' AND json_ok"""


def h13_total_improvement(spark, d):
    out = H.final_summary(gated(spark, d), event_baselines(spark, d))
    return out.withColumn("improvement_pct", F.round("improvement_pct", 6))


QUERIES["h13_total_improvement"] = h13_total_improvement
SQL["h13_total_improvement"] = f"""WITH RECURSIVE {gate_cte()},
y AS (SELECT experiment, count(*)::BIGINT AS trials, count(*) FILTER (hit)::BIGINT AS accepted, any_value(baseline) AS baseline,
  coalesce(min(primary_metric) FILTER (hit), any_value(baseline)) AS best FROM z GROUP BY experiment)
SELECT *, CASE WHEN baseline <> 0 AND best <> 0 THEN round(abs(best - baseline) / abs(baseline) * 100, 6) END AS improvement_pct FROM y"""


def h14_phase(spark, d):
    return event_trials(spark, d).select("experiment", "trial_id", H.phase(F.col("trial_id") + 1).alias("phase"))


QUERIES["h14_phase"] = h14_phase
SQL["h14_phase"] = f"WITH {TRIALS_CTE} SELECT experiment, trial_id, CASE WHEN trial_id + 1 <= 10 THEN 'EXPLORATION' ELSE 'EXPLOITATION' END AS phase FROM t"


def h15_resume_point(spark, d):
    t = order_trials(spark, d)
    base = t.groupBy("experiment").agg(F.round(F.avg("primary_metric"), 3).alias("primary_metric")).select(
        F.lit(-1).cast("bigint").alias("trial_id"), "experiment", F.lit("baseline").alias("decision"), "primary_metric"
    )
    return H.resume_point(t.select("trial_id", "experiment", "decision", "primary_metric").unionByName(base))


QUERIES["h15_resume_point"] = h15_resume_point
SQL["h15_resume_point"] = f"""WITH {OT} SELECT experiment, count(*)::BIGINT AS next_trial, round(avg(primary_metric), 3) AS baseline,
 coalesce(min(primary_metric) FILTER (decision = 'accepted'), round(avg(primary_metric), 3)) AS best FROM ot GROUP BY experiment"""


def h15_remaining(spark, d):
    """Of all candidate configs (one per customer), those not tried by an accepted order."""
    t = order_trials(spark, d)
    cands = table(spark, d, "customer", "c_custkey").select(
        F.col("c_custkey").alias("candidate"), F.concat(F.lit("h"), (F.col("c_custkey") % 120).cast("string")).alias("config_hash")
    )
    return H.remaining(cands, t).select("candidate", "config_hash")


QUERIES["h15_remaining"] = h15_remaining
SQL["h15_remaining"] = f"""WITH {OT} SELECT c_custkey AS candidate, 'h' || (c_custkey % 120) AS config_hash FROM customer
 WHERE 'h' || (c_custkey % 120) NOT IN (SELECT config_hash FROM ot)"""


def h16_seed_variation_stats(spark, d):
    s = H.seed_variation_stats(order_trials(spark, d))
    return s.select("config_hash", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


QUERIES["h16_seed_variation_stats"] = h16_seed_variation_stats
SQL["h16_seed_variation_stats"] = f"""WITH {OT} SELECT config_hash, count(primary_metric)::BIGINT AS n, round(avg(primary_metric), 4) AS mean,
 round(stddev_samp(primary_metric), 4) AS std FROM ot GROUP BY config_hash"""
