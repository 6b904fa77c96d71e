import random

import pandas as pd
from pyspark.sql import functions as F

from trialweave.plans.lookup import salted_lookup, sparse_lookup
from trialweave.plans.ordered import id_levels, number_rows, running_before, trailing_rows


def skewed(spark, n=400):
    """One key holds most rows; cells are tiny, so it spans many of them."""
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.8 else rnd.choice("abc"), i, rnd.random()) for i in range(n)]
    return pd.DataFrame(rows, columns=["k", "i", "v"]), spark.createDataFrame(rows, "k string, i bigint, v double")


def test_number_rows(spark):
    pdf, df = skewed(spark)
    pdf["want"] = pdf.sort_values("i").groupby("k").cumcount() + 1
    got = number_rows(df, ["k"], id_levels(F.col("i"), 3, 5), [F.col("i")]).toPandas().sort_values("i")
    assert list(got["rank"]) == list(pdf.sort_values("i")["want"])
    whole = number_rows(df, [], id_levels(F.col("i"), 3, 5), [F.col("i")]).toPandas().sort_values("i")
    assert list(whole["rank"]) == list(range(1, len(pdf) + 1))


def test_running_before(spark):
    pdf, df = skewed(spark)
    measures = {"lo": (F.col("v"), "min"), "hi": (F.col("v"), "max"), "s": (F.lit(1), "sum")}
    got = running_before(df, ["k"], id_levels(F.col("i"), 3, 5), [F.col("i")], measures).toPandas().sort_values("i")
    g = pdf.sort_values("i").groupby("k")["v"]
    for name, want in (("lo", g.transform(lambda x: x.cummin().shift())), ("hi", g.transform(lambda x: x.cummax().shift()))):
        assert got[name].reset_index(drop=True).equals(want.sort_index().reset_index(drop=True))
    assert list(got["s"]) == list(g.cumcount())


def test_null_keys_are_a_key_of_their_own(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("a", None)], "k string, i bigint")
    got = number_rows(df, ["k"], id_levels(F.col("i"), 1, 2), [F.col("i")]).collect()
    assert sorted((str(r.k), str(r.i), r["rank"]) for r in got) == [("None", "1", 1), ("None", "3", 2), ("a", "2", 2), ("a", "None", 1)]


def test_trailing_rows(spark):
    pdf, df = skewed(spark)
    seq = number_rows(df, ["k"], id_levels(F.col("i")), [F.col("i")], "seq")
    got = trailing_rows(seq, ["k"], "seq", 4, {"a": lambda w: F.max("v").over(w)}, cell=5).toPandas().sort_values("i")
    want = pdf.sort_values("i").groupby("k")["v"].transform(lambda x: x.rolling(4, min_periods=1).max())
    assert len(got) == len(pdf) and list(got["a"]) == list(want)


def test_lookups_agree_with_a_plain_join(spark):
    _, df = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("a", 2), ("zzz", 3)], "k string, d int")
    want = sorted(map(tuple, df.join(dim, "k", "left").select("i", "d").collect()))
    for f in (salted_lookup, sparse_lookup):
        assert sorted(map(tuple, f(df, dim, ["k"], ["i"]).select("i", "d").collect())) == want


def test_no_window_over_the_rows_of_a_whole_key(spark):
    _, df = skewed(spark)
    out = number_rows(df, ["k"], id_levels(F.col("i")), [F.col("i")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and "_l1" in windows[0] and "Join" not in plan


def test_chunk_lookup(spark):
    from pyspark.sql import types as T

    from trialweave.plans.lookup import chunk_lookup

    rows = [(i, ["the"] * (i % 5) + [f"w{i % 7}", "rare"]) for i in range(60)] + [(60, []), (61, None), (62, [None, "the"])]
    df = spark.createDataFrame(rows, "doc_id bigint, ws array<string>")
    known = spark.createDataFrame([("the", 1), ("w3", 3), ("unused", 9)], "tok string, value int")
    asked = []

    def find(words):
        asked.append(words)
        return words.join(known, "tok")

    out = chunk_lookup(df, "doc_id", "ws", find, "ids", T.IntegerType(), chunks=6)
    got = {r["doc_id"]: (r["ws"], r["ids"]) for r in out.collect()}
    ids = {"the": 1, "w3": 3}
    assert got == {i: (ws, None if ws is None else [ids.get(w) for w in ws]) for i, ws in rows}
    # a word is asked for once a chunk, and making the questions moves whole rows only
    assert asked[0].filter("tok = 'the'").count() <= 6
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
