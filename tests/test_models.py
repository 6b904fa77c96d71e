import collections
import json
import math
import re

from pyspark.sql import functions as F

from trialweave.operators import models as J
from trialweave.operators.counts import neighbour_counts


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_unigram_by_hand(spark, tmp_path):
    model = J.train_lm(docs(spark, "a a b", "c"))
    r = J.score_lm(model, docs(spark, "a zz")).first()
    want = -(math.log(3 / 7) + math.log(1 / 7)) / 2
    assert r.tokens == 2 and math.isclose(r.loss, want) and math.isclose(r.perplexity, math.exp(want))
    path = str(tmp_path / "lm")
    J.save_lm(model, path)
    assert math.isclose(J.score_lm(J.load_model(spark, path), docs(spark, "a zz")).first().loss, want)


def test_bigram_by_hand(spark):
    model = J.train_lm(docs(spark, "a b a b a c"), order=2, k=0.5)
    r = J.score_lm(model, docs(spark, "a b q")).first()
    # followers seen: b, a, c; after a: b twice, c once; after b: a twice
    want = -(math.log(2.5 / 4.5) + math.log(0.5 / 3.5)) / 2
    assert r.tokens == 2 and math.isclose(r.loss, want)


def test_neighbours_counted_by_tasks(spark):
    texts = ["a b a b\u2003a\x1cc", None, "", " b ", "a  b\n\nc", "é é\x85é", "a b"] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    want = collections.Counter()
    for t in texts:
        ws = re.split(r"[\s\x1c]+", (t or "").strip())
        want.update(zip(ws, ws[1:]))
    for held_words in (1, 4, 1000):
        got = neighbour_counts(rows, "text", "x", "y", "n", held_words).collect()
        assert {(r.x, r.y): r.n for r in got} == want and len(got) == len(want)


def test_few_texts_do_not_shuffle_the_model(spark):
    model = J.train_lm(docs(spark, "a b a b a c", "d e"), order=2, k=0.5)
    plan = J.score_lm(model, docs(spark, "a b q"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # grams and contexts are cut to those asked for


def test_sweep_equals_single_models(spark):
    train, held = docs(spark, "a b c a", "b b d e f g"), docs(spark, "a b zz", "g g")
    got = {r.trial_id: r for r in J.trial_sweep(train, held, [{}, {"pipeline": {"enabled": False}}]).collect()}
    want = J.score_lm(J.train_lm(train), held).first().loss
    assert all(math.isclose(r.loss, want) for r in got.values()) and len(got) == 2


def test_predict(spark):
    df = spark.createDataFrame([(0, [(3, 1.0), (5, 2.0)]), (1, [(3, 2.0), (5, 2.0)])], "id int, logits array<struct<label:int,logit:double>>")
    r = J.predict(df).orderBy("id").collect()
    assert r[0].prediction == 5 and math.isclose(r[0].probability, 1 / (1 + math.exp(-1))) and (r[1].prediction, r[1].probability) == (3, 0.5)


def test_text_classifier_learns(spark, tmp_path):
    rows = [(i, ("good fine great " if i % 2 else "bad poor awful ") + f"w{i % 5}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    cfg = {"pipeline": {"enabled": True, "text_augmentations": [{"name": "random_swap", "enabled": True, "probability": 0.5}]}}
    model, scored, metrics = J.train_text_classifier(df, config=cfg, features=256)
    m = metrics.first()
    assert m.accuracy > 0.95 and m.samples == scored.count() and m.loss < 0.5
    path = str(tmp_path / "m")
    J.save_classifier(model, path)
    assert J.load_model(spark, path).stages[0].getNumFeatures() == 256


def test_classifier_sweep_equals_single_runs(spark):
    rows = [(i, ("good " if i % 2 else "bad ") + f"w{i % 7} w{i % 3}", i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    cfg = {"pipeline": {"enabled": True, "text_augmentations": [{"name": "random_deletion", "enabled": True, "probability": 0.4}]}}
    got = {r.trial_id: r for r in J.classifier_sweep(df, [{}, cfg], parallel=2, features=64).collect()}
    for i, c in enumerate([{}, cfg]):
        want = J.train_text_classifier(df, config=c, features=64)[2].first()
        assert math.isclose(got[i].loss, want.loss, rel_tol=1e-6) and got[i].accuracy == want.accuracy


def test_centroids(spark, tmp_path, monkeypatch):
    rows = [(i, [float(i % 5) * 4, 1.0, float(i % 2)], i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, pixels array<double>, label int")
    centre = {k: [4.0 * k, 1.0, 0.5] for k in range(5)}
    want = {}
    for i, x, _ in rows:
        logit = {k: -sum((a - b) ** 2 for a, b in zip(x, c)) for k, c in centre.items()}
        top = max(logit.values())
        want[i] = (min(k for k in logit if logit[k] == top), 1 / sum(math.exp(v - top) for v in logit.values()))
    for values in (1 << 16, 6, 1):  # one block, blocks of two, a block for each
        monkeypatch.setattr(J, "BLOCK_VALUES", values)
        model = J.train_centroids(df)
        assert model.count == {1 << 16: 1, 6: 3, 1: 5}[values]
        path = str(tmp_path / str(values))
        J.save_centroids(model, path)
        for m in (model, J.load_model(spark, path)):
            got = {r["id"]: (r["prediction"], r["probability"], r["label"]) for r in J.predict_centroids(df, m, keep=["label"], salts=3).collect()}
            assert all(got[i][0] == want[i][0] and math.isclose(got[i][1], want[i][1]) and got[i][2] == i % 5 for i in want)


def test_sweep_reads_the_texts_once(spark, tmp_path):
    words = "a b c d e f g h".split()
    train = docs(spark, *[" ".join(words[: 1 + i % 8] * 2) for i in range(30)])
    held = docs(spark, "a b zz", "h h")
    entry = lambda name, p: {"pipeline": {"enabled": True, "text_augmentations": [{"name": name, "enabled": True, "probability": p}]}}
    configs = [entry("random_deletion", 0.1 * i) if i % 2 else entry("random_swap", 0.1 * i) for i in range(10)]
    table = spark.createDataFrame([(i + 5, json.dumps(c)) for i, c in enumerate(configs)], "trial_id bigint, config string")
    got = {r["trial_id"]: r for r in J.trial_sweep(train, held, table).collect()}
    for i, c in enumerate(configs):
        texts = J.TextAugmenter(c).apply(train)
        model = J.train_lm(texts)
        r = got[i + 5]
        assert math.isclose(r["loss"], J.score_lm(model, held).first().loss) and r["vocabulary"] == model.vocabulary
        assert r["train_tokens"] == model.contexts.agg(F.sum("total")).first()[0]
    path = str(tmp_path / "train")
    train.write.parquet(path)
    for n in (2, 10):
        read = spark.read.parquet(path)
        scans = []
        real = J.materialize
        J.materialize = lambda df, name: scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")) or real(df, name)
        try:
            J.trial_sweep(read, held, configs[:n])
        finally:
            J.materialize = real
        assert scans[0] == 1


def test_word_counts_of_tasks(spark):
    from pyspark.sql import functions as F

    from trialweave.functions.texts import BLANKS, words
    from trialweave.operators.counts import token_counts, word_counts

    texts = ["a b a c", None, "", " \x1c", "b\x85b", "a"] * 3
    df = spark.createDataFrame([(i % 4 if i % 4 else None, i % 3 - 1, t) for i, t in enumerate(texts)], "g bigint, s int, text string").repartition(3)
    plain = df.select("g", "s", F.explode(F.filter(F.split("text", BLANKS), lambda w: w != "")).alias("tok"))
    rows = lambda x: sorted(map(str, x.collect()))
    for held in (2, 1000):
        assert rows(word_counts(df, "text", "tok", "c", held_counts=held)) == rows(plain.groupBy("tok").agg(F.count(F.lit(1)).alias("c")))
        got = word_counts(df, "text", "tok", "c", by="g", weight="s", held_counts=held)
        assert rows(got) == rows(plain.groupBy("g", "tok").agg(F.sum("s").alias("c")))
        # words become rows of a task's counts, not of their own
        assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    arrays = df.select(words("text").alias("ws")).union(spark.createDataFrame([([None, "a", ""],)], "ws array<string>"))
    assert rows(token_counts(arrays, "ws", "tok", "cnt")) == rows(arrays.select(F.explode("ws").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("cnt")))


def test_words_of_every_blank(spark):
    from pyspark.sql import functions as F

    from trialweave.functions.texts import BLANKS, words

    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(f"a{chr(c)}b{chr(c)}{chr(c)} c",) for c in points], "text string")
    old = F.filter(F.split("text", BLANKS), lambda w: w != "")
    assert df.filter(~words(F.col("text")).eqNullSafe(old)).isEmpty()


def test_whole_vocabulary_counts_and_deals_texts_once(spark):
    from trialweave.operators import prepare as P
    from trialweave.plans import ordered

    df = P.tokenize(spark.createDataFrame([(i, f"a b{i % 5} c{i}") for i in range(40)], "doc_id bigint, text string"))
    given = []
    cells, ordered_cells = P.range_cells, ordered.range_cells
    try:
        P.range_cells = lambda counts, order: given.append(counts) or ordered_cells(counts, order)
        vocab = P.build_vocab(df).cache()
    finally:
        P.range_cells = cells
    # the counts that cells are cut from are stored: their plan reads a file and counts nothing
    assert "Aggregate" not in given[0]._jdf.queryExecution().executedPlan().toString()
    out = P.encode(df, vocab)
    ids = {r["tok"]: r["id"] for r in vocab.collect()}
    assert {r["doc_id"]: r["input_ids"] for r in out.collect()} == {i: [ids["a"], ids[f"b{i % 5}"], ids[f"c{i}"]] for i in range(40)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan, plan
