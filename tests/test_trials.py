import math
import random

import pytest
from pyspark.sql import functions as F

from trialweave.operators import trials as H
from trialweave.sources.trials import append_trials, read_trials

# direction, status, error, primary, baseline, best, safe -> accepted
CASES = [
    ("minimize", None, None, 3.5, None, None, True, True),
    ("minimize", None, None, 3.0, 3.5, 3.5, True, True),
    ("minimize", None, None, 3.5, 3.5, 3.5, True, False),
    ("minimize", None, None, 4.0, 3.5, 3.5, True, False),
    ("minimize", "error", "OOM", None, 3.5, 3.5, True, False),
    ("minimize", None, None, 2.0, 3.5, 3.5, False, False),
    ("maximize", None, None, 0.95, 0.90, 0.90, True, True),
    ("maximize", None, None, 0.90, 0.90, 0.90, True, False),
    ("minimize", None, None, 3.4965, 3.5, 3.5, True, False),
    ("minimize", None, None, 3.0, 3.5, None, True, True),
    ("minimize", None, None, 1.0, 0.0, None, True, False),
    ("minimize", None, None, float("nan"), 3.5, None, True, False),
    ("minimize", None, None, None, 3.5, 3.5, True, False),
]
SCHEMA = "i int, status string, error string, primary_metric double, baseline double, best double, safe boolean"


@pytest.mark.parametrize("direction", ["minimize", "maximize"])
def test_decide_cases(spark, direction):
    rows = [(i, *c[1:7]) for i, c in enumerate(CASES) if c[0] == direction]
    got = {r.i: r for r in H.decide(spark.createDataFrame(rows, SCHEMA), direction=direction).collect()}
    for i, c in enumerate(CASES):
        if c[0] == direction:
            assert got[i].accepted == c[7], c
    if direction == "minimize":
        assert got[1].improvement == pytest.approx(0.142857, abs=1e-6)
        assert got[1].reason == "Improved eval_loss by 0.1429 (14.29%) over best (3.5000 → 3.0000)"
        assert got[3].reason == "Insufficient improvement: -0.1429 (-14.29%) < threshold 0.50% (current: 4.0000, best: 3.5000)"
        assert got[4].reason == "Trial failed: OOM" and got[4].improvement == 0.0
        assert got[5].reason.startswith("Safety") and "baseline" in got[9].reason
        assert got[12].reason == "Primary metric 'eval_loss' not found in results"


def fold(rows, direction, threshold, patience, baseline):
    """One trial after the other. rows: (trial, status, value, short, safe)"""
    best, fails, stopped, out = None, 0, False, {}
    for t, status, value, short, safe in sorted(rows):
        if status == "exception":
            continue
        v = value if value is not None else short
        ref = best if best is not None else baseline
        ok = status not in ("error", "failed") and v is not None and safe
        if ok and ref is not None:
            gain = 0.0 if ref == 0 else ((ref - v) if direction == "minimize" else (v - ref)) / abs(ref)
            ok = gain >= threshold
        fails = 0 if ok else fails + 1
        out[t] = (ok, fails, not stopped, best)
        if ok and value is not None:
            best = value
        stopped = stopped or fails >= patience
    return out


def series(kind, rnd, n):
    if kind == "falling":
        return [1000.0 - i for i in range(n)]
    if kind == "small steps":
        return [100.0 * 0.999**i for i in range(n)]
    if kind == "negative":
        return [-float(i % 17) - i / 10 for i in range(n)]
    if kind == "zeros":
        return [float(rnd.choice([-1, 0, 0, 1, 2])) for _ in range(n)]
    if kind == "nan first":
        return [math.nan] + [rnd.random() for _ in range(n - 1)]
    if kind == "nans":
        return [math.nan if rnd.random() < 0.3 else rnd.random() for _ in range(n)]
    return [rnd.random() * 100 for _ in range(n)]


KINDS = ["falling", "small steps", "negative", "zeros", "nan first", "nans", "random", "messy"]


@pytest.mark.parametrize("direction,threshold,patience", [("minimize", 0.005, 6), ("maximize", 0.02, 9), ("minimize", 0.0, 5)])
def test_gate_equals_the_sequential_fold(spark, direction, threshold, patience):
    rnd = random.Random(5)
    rows, bases, want = [], [], {}
    for k in KINDS:
        for b in (None, 50.0, 0.0):
            name = f"{k}/{b}"
            mine = []
            for t, v in enumerate(series(k, rnd, 120)):
                status = safe = short = None
                value, safe = v, True
                if k == "messy":
                    status = rnd.choice([None] * 6 + ["error", "failed", "exception"])
                    safe = rnd.random() > 0.1
                    if rnd.random() < 0.2:
                        value, short = None, (v if rnd.random() < 0.7 else None)
                mine.append((t * 50, status, value, short, safe))
            want[name] = fold(mine, direction, threshold, patience, b)
            rows += [(name, *m) for m in mine]
            if b is not None:
                bases.append((name, b))
    df = spark.createDataFrame(rows, "experiment string, trial_id bigint, status string, primary_metric double, short double, safe boolean")
    df = df.withColumn("eval_metrics", F.when(F.col("short").isNotNull(), F.create_map(F.lit("loss"), F.col("short"))))
    base = spark.createDataFrame(bases, "experiment string, baseline double")
    got = H.sequential_gate(df, direction=direction, threshold=threshold, patience=patience, baselines=base).collect()
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        ok, fails, ran, best = want[r.experiment][r.trial_id]
        same = r.best == best or (r.best is not None and best is not None and math.isnan(r.best) and math.isnan(best))
        assert (r.accepted, r.fails, r.ran, same) == (ok, fails, ran, True), (r, want[r.experiment][r.trial_id])


def test_gate_without_baselines_and_patience(spark):
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate([5.0, 4.0, 4.5, 3.0])], "experiment string, trial_id bigint, primary_metric double")
    got = H.sequential_gate(df, patience=None).orderBy("trial_id").collect()
    assert [r.accepted for r in got] == [True, True, False, True] and all(r.ran for r in got)
    stops = H.stop_points(H.sequential_gate(df, patience=1), patience=1).collect()
    assert stops[0].stopped_at == 2


def test_log_and_history(spark, tmp_path):
    path = str(tmp_path / "trials")
    schema = "trial_id bigint, decision string, primary_metric double"
    append_trials(spark.createDataFrame([(0, "accepted", 3.0), (1, "rejected", 2.0)], schema), path)
    append_trials(spark.createDataFrame([(2, "accepted", 1.0), (3, None, None)], schema), path)
    t = read_trials(spark, path)
    assert [r.trial_id for r in H.history(t, 2).collect()] == [3, 2]
    assert H.best_trial(t).first().trial_id == 2 and H.best_trial(t, "maximize").first().trial_id == 0
    s = H.stats(t).first()
    assert (s.total_trials, s.accepted, s.rejected, s.acceptance_rate) == (4, 2, 2, 0.5)
    last = t.filter("trial_id = 3").first()
    assert (last.decision, last.metrics_json, last.diff_json) == ("unknown", "{}", "[]") and last.timestamp is not None
    empty = H.stats(t.filter("false")).first()
    assert empty.total_trials == 0 and empty.acceptance_rate == 0.0


def test_accepted_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "trials")
    append_trials(spark.createDataFrame([(0, "accepted"), (1, "rejected")], "trial_id bigint, decision string"), path)
    plan = H.accepted_trials(read_trials(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decision" in plan


def test_largest_accepted_is_exact():
    import numpy as np

    rng = np.random.default_rng(3)
    refs = np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-12, 12, 200), [0.0, -0.0, np.nan, np.inf, -np.inf, 5e-324, 1e308, -1e308, 1.0, -1.0]])
    for threshold in (1e-20, 0.005, 0.1, 1.0, 3.0):
        found = H.largest_accepted(refs, threshold)
        for ref, best in zip(refs.tolist(), found.tolist()):
            if ref == 0 or not np.isfinite(ref):
                assert np.isnan(best)
                continue
            with np.errstate(over="ignore"):
                gain = lambda v: (np.float64(ref) - v) / abs(np.float64(ref))  # noqa: B023, E731
                assert gain(best) >= threshold and not gain(np.nextafter(best, np.inf)) >= threshold


def test_gate_over_a_long_fall(spark):
    """Every trial is a record, and a few hundred of them move the best value."""
    values = [1000.0 * 0.999**i for i in range(3000)]
    rows = [("fall", i, v) for i, v in enumerate(values)] + [("nan", 0, float("nan")), ("nan", 1, 1.0), ("zero", 0, 0.0), ("zero", 1, -5.0), ("based", 0, 9.99), ("based", 1, 9.0), ("dead", 0, 1.0)]
    df = spark.createDataFrame(rows, "experiment string, trial_id bigint, primary_metric double").repartition(8)
    base = spark.createDataFrame([("based", 10.0), ("dead", 0.0)], "experiment string, baseline double")
    best, want = None, []
    for i, v in enumerate(values):
        if best is None or (best - v) / abs(best) >= 0.005:
            best = v
            want.append(i)
    out = H.sequential_gate(df, baselines=base, patience=None)
    got = {}
    for r in out.filter("accepted").collect():
        got.setdefault(r["experiment"], []).append(r["trial_id"])
    assert sorted(got.pop("fall")) == want and len(want) > 500 - 100
    assert {k: sorted(v) for k, v in got.items()} == {"nan": [0], "zero": [0], "based": [1]}
