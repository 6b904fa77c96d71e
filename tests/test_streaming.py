import datetime
import os
import random
import time

from pyspark.sql import functions as F

from trialweave.catalog import streams as S
from trialweave.operators import metrics as M
from trialweave.operators import trials as H
from trialweave.operators.text_augment import TextAugmenter
from trialweave.streaming import jobs as K


def drop(df, folder, name):
    """One more file for a file stream, younger than those before it."""
    df.coalesce(1).write.parquet(f"{folder}/.part-{name}")
    made = [f for f in os.listdir(f"{folder}/.part-{name}") if f.endswith(".parquet")][0]
    target = f"{folder}/{name}.parquet"
    os.link(f"{folder}/.part-{name}/{made}", target)
    stamp = time.time() - 1000 + int(name)
    os.utime(target, (stamp, stamp))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")


def test_tracker_over_batches(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(rnd.choice("ab"), i, float("nan") if rnd.random() < 0.1 else rnd.random()) for i in range(90)]
    rows = [("c", i, float("nan") if i == 0 else 1.0 / (i + 1)) for i in range(90)] + rows
    schema = "run string, step bigint, value double"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)
    for b in range(3):
        part = [r for r in rows if r[1] // 30 == b]
        if b == 2:
            part += [("a", 1, -5.0), ("b", 2, -5.0)]  # late: these steps have passed
        drop(spark.createDataFrame(part, schema), folder, str(b))
    q = K.stream_metric_tracker(stream(spark, folder, schema), out, direction="maximize")
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 2
    # the last micro-batch once more, as after a failure between output and commit
    before = sorted(map(str, K.state_of(spark, out).collect()))
    os.remove(f"{out}/checkpoint/commits/2")
    os.remove(f"{out}/checkpoint/commits/.2.crc")
    K.stream_metric_tracker(stream(spark, folder, schema), out, direction="maximize").awaitTermination()
    assert sorted(map(str, K.state_of(spark, out).collect())) == before
    df = spark.createDataFrame(rows, schema)
    show = lambda d: sorted((r.run, r.step, str(r.value), r.improved) for r in d.collect())
    assert show(K.tracker_flags(spark, out)) == show(M.improved(df, direction="maximize"))
    late = K.BatchStore(spark, out).read("late").collect()
    assert sorted((r.run, r.step) for r in late) == [("a", 1), ("b", 2)]
    cols = ["run", "latest", "best", "best_step", F.round("avg_last_10", 9).alias("avg"), "n_values"]
    text = lambda d: sorted(str(tuple(r)) for r in d.select(*cols).collect())
    assert text(K.tracker_summary(spark, out, 2)) == text(M.metric_summary(df, direction="maximize"))


def test_only_touched_series_are_updated(spark, tmp_path):
    schema = "run string, step bigint, value double"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)
    parts = [[("a", 1, 3.0), ("b", 1, None), ("a", 5000, 2.0), ("a", 5000, 2.5)], [("b", 2, 1.0), ("b", 2, float("nan"))], [("a", 4999, 0.0), ("c", 1, 1.0)]]
    for b, part in enumerate(parts):
        drop(spark.createDataFrame(part, schema), folder, str(b))
    K.stream_metric_tracker(stream(spark, folder, schema), out).awaitTermination()
    for b, touched in enumerate(("ab", "b", "ac")):
        arrived = spark.read.parquet(K.BatchStore(spark, out).part("arrived", b)).filter("carry IS NOT NULL")
        assert sorted(r[0] for r in arrived.select("carry.run").collect()) == list(touched)
    state = {r["run"]: (r["s_last"], r["s_n"], str(r["s_best"]), r["s_stuck"]) for r in K.state_of(spark, out).collect()}
    # a: its late value changes nothing; b began with NaN and stays there
    assert state == {"a": (5000, 2, "2.0", False), "b": (2, 2, "nan", True), "c": (1, 1, "1.0", False)}
    flags = {(r["run"], r["step"]): r["improved"] for r in K.tracker_flags(spark, out).collect()}
    assert flags == {("a", 1): True, ("a", 5000): True, ("b", 1): True, ("b", 2): False, ("c", 1): True}


def test_gate_over_batches(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(rnd.choice("abc"), i, rnd.random() * 100, rnd.random() > 0.1) for i in range(240)]
    schema = "experiment string, trial_id bigint, primary_metric double, safe boolean"
    base = spark.createDataFrame([("a", 60.0)], "experiment string, baseline double")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)
    for b in range(3):
        drop(spark.createDataFrame([r for r in rows if r[1] // 80 == b], schema), folder, str(b))
    K.stream_trial_gate(stream(spark, folder, schema), out, baselines=base, patience=25).awaitTermination()
    cols = ["experiment", "trial_id", "best", "accepted", "fails", "ran", "reason"]
    show = lambda d: sorted(map(tuple, d.select(*cols).collect()))
    want = show(H.sequential_gate(spark.createDataFrame(rows, schema), baselines=base, patience=25))
    assert show(K.gate_decisions(spark, out)) == want and len(want) == 240 and not all(w[5] for w in want)


def test_gate_state_follows_the_batch_gate(spark, tmp_path):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        own = None if i % 7 == 0 else float("nan") if i % 23 == 0 else round(rnd.random() * 100 - (i > 200) * 60, 1)
        short = {"loss": rnd.random() * 100} if i % 7 == 0 and i % 2 else None
        rows.append((rnd.choice("abcd"), i * 37, "exception" if i % 19 == 0 else "failed" if i % 31 == 0 else None, own, short, rnd.random() > 0.1))
    schema = "experiment string, trial_id bigint, status string, primary_metric double, eval_metrics map<string,double>, safe boolean"
    base = spark.createDataFrame([("a", 60.0), ("b", 0.0)], "experiment string, baseline double")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)
    for b in range(4):
        drop(spark.createDataFrame(rows[b * 100 : b * 100 + 100] + rows[b * 50 : b * 50 + 3], schema), folder, str(b))
    for direction, threshold in (("minimize", 0.005), ("maximize", 0.0)):
        at = f"{out}-{direction}"
        K.stream_trial_gate(stream(spark, folder, schema), at, baselines=base, patience=15, direction=direction, threshold=threshold).awaitTermination()
        cols = ["experiment", "trial_id", "best", "accepted", "fails", "ran", "reason"]
        show = lambda d: sorted(map(str, d.select(*cols).collect()))
        gate = H.sequential_gate(spark.createDataFrame(rows, schema), baselines=base, patience=15, direction=direction, threshold=threshold)
        assert show(K.gate_decisions(spark, at)) == show(gate)
        ends = {r["experiment"]: r for r in gate.groupBy("experiment").agg(F.max_by("fails", "trial_id").alias("fails"), F.max("trial_id").alias("last")).collect()}
        for r in K.state_of(spark, at).collect():
            assert (r["s_last"], r["fails"]) == (ends[r["experiment"]]["last"], ends[r["experiment"]]["fails"])


def test_runs_closed_by_end_or_timer(spark, tmp_path):
    schema = "run string, kind string, ts timestamp, accepted boolean, reason string"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)
    at = lambda m: datetime.datetime(2026, 1, 1) + datetime.timedelta(minutes=m)
    first = [("a", "metric", at(0), None, None), ("b", "metric", at(1), None, None), ("b", "end", at(2), True, "good"), ("c", "metric", at(3), None, None)]
    second = [("c", "metric", at(50), None, None), ("d", "metric", at(100), None, None)]
    third = [("e", "metric", at(300), None, None), ("b", "metric", at(301), None, None)]
    for b, part in enumerate((first, second, third)):
        drop(spark.createDataFrame(part, schema), folder, str(b))
    K.stream_run_ends(stream(spark, folder, schema), out, timeout="1 hour").awaitTermination()
    got = sorted((r["run"], r["closed_by"], r["accepted"], r["reason"], r["ended_at"], r["points"]) for r in spark.read.parquet(f"{out}/data").collect())
    assert got == [("a", "timeout", None, None, at(60), 1), ("b", "end", True, "good", at(2), 1), ("c", "timeout", None, None, at(110), 2), ("d", "timeout", None, None, at(160), 1)]


def test_replayed_batch_replaces_its_output(spark, tmp_path):
    store = K.BatchStore(spark, str(tmp_path))
    for _ in range(2):
        store.write(spark.range(5), "flags", 0)
    assert store.read("flags").count() == 5


def test_row_wise_streams(spark, tmp_path):
    schema = "doc_id bigint, text string"
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    docs = spark.createDataFrame([(i, f"word{i} mail a{i}@b.org one two" if i % 3 == 0 else f"plain text number {i}x") for i in range(30)], schema)
    for b in range(2):
        drop(docs.filter(F.col("doc_id") % 2 == b), folder, str(b))
    lex = spark.createDataFrame([("one", ["uno"]), ("plain", ["simple"])], "word string, synonyms array<string>")
    entries = [{"name": "random_swap", "enabled": True, "probability": 0.5}]
    chains = [TextAugmenter({"pipeline": {"enabled": True, "text_augmentations": entries}})]
    entries = entries + [{"name": "synonym_replacement", "enabled": True, "probability": 0.9}]
    chains.append(TextAugmenter({"pipeline": {"enabled": True, "text_augmentations": entries}}, lexicon=lex))
    for i, chain in enumerate(chains):
        K.stream_augment(stream(spark, folder, schema), chain, str(tmp_path / f"aug{i}")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / f"aug{i}" / "data")).select("doc_id", "text")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, chain.apply(docs).select("doc_id", "text").collect()))
    K.stream_safety(stream(spark, folder, schema), str(tmp_path / "safe")).awaitTermination()
    screened = spark.read.parquet(str(tmp_path / "safe" / "data")).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in screened} == {"quarantine": 10, "clean": 20}


def test_run_log(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    (folder / "a.json").write_text(
        '{"run":"r1","kind":"metric","step":1,"metric":"loss","value":0.5}\n{"run":"r2","kind":"metric","step":1,"metric":"loss","value":0.7}\n'
        '{"run":"r1","kind":"end","accepted":true,"reason":"better","at":"2024-01-01T00:00:00"}\n'
    )
    out = str(tmp_path / "log")
    K.stream_run_log(K.read_run_events(spark, str(folder)), out).awaitTermination()
    (folder / "b.json").write_text('{"run":"r2","kind":"metric","step":2,"metric":"loss","value":0.6}\n')
    K.stream_run_log(K.read_run_events(spark, str(folder)), out).awaitTermination()
    metrics, runs = K.run_log(spark, out)
    assert metrics.count() == 3
    got = {r.run: (r.closed, r.accepted, r.reason, r.points) for r in runs.collect()}
    assert got == {"r1": (True, True, "better", 1), "r2": (False, None, None, 2)}


def test_tables_of_one_or_many_files_are_streamed(spark, tmp_path):
    rows = [(i, f"call {i} or write to a{i}@example.com" if i % 3 else f"nothing {i}") for i in range(12)] + [(12, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    docs.repartition(3).write.parquet(f"{many}/documents.parquet")
    os.makedirs(one)
    docs.coalesce(1).write.parquet(f"{one}/.made")
    made = [f for f in os.listdir(f"{one}/.made") if f.endswith(".parquet")][0]
    os.link(f"{one}/.made/{made}", f"{one}/documents.parquet")
    docs.write.parquet(f"{one}/other.parquet")  # a table beside it is no part of it
    for query in (S.k3_stream_augment, S.k4_stream_safety):
        found = [sorted(map(str, query(spark, d).collect())) for d in (many, one)]
        assert len(found[0]) == 13
        assert found[0] == found[1]
