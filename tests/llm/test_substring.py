"""Repeated windows of words against a plain loop."""

import math
import random

from pyspark.sql import functions as F

from trialweave.llm import debruijn_dedup as dd


def plain(rows, window):
    """(id, words, removed, text left) of each row."""
    docs = [(-math.inf if i is None else i, (t or "").encode().split()) for i, t in rows]
    low = {}
    for i, w in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            low[k] = min(low.get(k, i), i)
    out = []
    for (i, _), (n, w) in zip(rows, docs):
        gone = {q for p in range(len(w) - window + 1) if low[tuple(w[p : p + window])] < n for q in range(p, p + window)}
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def same(df, window=dd.WINDOW, gram=dd.GRAM):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = dd.substring_dedup(df, window=window, gram=gram).select("id", "n_words", "n_removed", "text", "n_unverified").collect()
    assert all(r["n_unverified"] == 0 for r in got)
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(plain(rows, window), key=key)


def test_odd_rows(odd):
    same(odd)


def test_branches_cycles_and_copies(spark):
    rng = random.Random(8)
    few = [rng.choice("ab") for _ in range(400)]
    rows = [(k, " ".join(few[a : a + rng.randint(5, 90)])) for k, a in enumerate(rng.randint(0, 300) for _ in range(60))]
    rows += [(70, "a " * 200), (71, "a b " * 90), (72, "a " * 40), (73, "a b c " * 40), (74, " ".join(few)), (75, " ".join(few)), (75, " ".join(few[50:])), (69, "b a " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cid", F.lit("x")).withColumn("hid", F.lit("y"))
    same(df, window=13, gram=5)
    same(df, window=4, gram=2)


def test_kept_columns(odd):
    out = dd.substring_dedup(odd, keep=["lang", "source"])
    assert out.select("keep.lang").count() == odd.count()


def test_nothing(none):
    assert dd.substring_dedup(none).count() == 0
