import math
import random

import pytest
from pyspark.sql import functions as F

from trialweave.operators import metrics as M


def track(values, direction):
    best = best_step = None
    flags = []
    for step, v in enumerate(values):
        better = best is None or (v < best if direction == "minimize" else v > best)
        flags.append(better)
        if better:
            best, best_step = v, step
    return flags, best, best_step


@pytest.mark.parametrize("direction", ["minimize", "maximize"])
def test_tracker_with_nan(spark, direction):
    rnd = random.Random(2)
    nan = math.nan
    runs = {
        "plain": [rnd.random() for _ in range(60)],
        "first": [nan, 1.0, 0.5],
        "middle": [3.0, nan, 2.0, nan, 2.0, 5.0],
        "only": [nan, nan],
        "one": [1.5],
    }
    df = spark.createDataFrame([(k, i, v) for k, vs in runs.items() for i, v in enumerate(vs)], "run string, step bigint, value double")
    got = {}
    for r in M.improved(df, direction=direction).collect():
        got.setdefault(r.run, {})[r.step] = r.improved
    summary = {r.run: r for r in M.metric_summary(df, direction=direction).collect()}
    bests = {r.run: r for r in M.best(df, direction=direction).collect()}
    for k, vs in runs.items():
        flags, best, step = track(vs, direction)
        assert [got[k][i] for i in range(len(vs))] == flags, k
        for r in (summary[k], bests[k]):
            assert r.best_step == step and (r.best == best or (math.isnan(r.best) and math.isnan(best)))
        assert summary[k].n_values == len(vs)
        last = vs[-10:]
        mean = sum(last) / len(last)
        assert math.isnan(mean) and math.isnan(summary[k].avg_last_10) or summary[k].avg_last_10 == pytest.approx(mean)


def test_running_average_is_shorter_at_the_start(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(15)], "run string, step bigint, value double")
    got = [r.running_avg for r in M.running_average(df, window=4).orderBy("step").collect()]
    assert got == [sum(range(max(0, i - 3), i + 1)) / len(range(max(0, i - 3), i + 1)) for i in range(15)]


def test_losses(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 8.0)], "batch_id int, loss double")
    assert M.eval_loss(df).first().loss == 5.0 and M.eval_loss(df, weighting="sample").first().loss == 4.0
    assert M.eval_loss(df.filter("false")).first().loss == 0.0
    assert M.limit_batches(df, 1).count() == 2 and M.limit_batches(df, None).count() == 3


def test_accuracies(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "pred int, label int")
    assert M.accuracy(df).first().accuracy == 0.5 and M.accuracy(df.filter("false")).count() == 0
    rows = [([5, 7, 9], [1, 5, 7]), ([1, 2, 3], [0, -100, 9]), ([4], [4])]
    t = spark.createDataFrame(rows, "pred array<int>, labels array<int>")
    got = M.token_accuracy(t).first()
    assert (got.tokens, got.accuracy) == (3, pytest.approx(2 / 3))
    ignored = spark.createDataFrame([([1, 2], [3, -100])], "pred array<int>, labels array<int>")
    assert M.token_accuracy(ignored).first().accuracy == 0.0


def test_derived(spark):
    df = spark.createDataFrame([(2.0,), (1000.0,)], "loss double")
    rows = df.select(M.perplexity(F.col("loss")).alias("p"), M.bits_per_byte(F.col("loss")).alias("b")).collect()
    assert rows[0].p == pytest.approx(math.exp(2)) and rows[1].p == math.inf
    assert rows[0].b == pytest.approx(2 * math.log2(math.e) / 4)
