"""The vector index finds every nearest neighbour, however little its first round sees."""

import numpy as np
from pyspark.sql import functions as F

from trialweave.llm import multi_index


def test_unstructured_vectors_beyond_reach(spark):
    x = np.random.default_rng(3).normal(size=(1500, 12))
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest(df, F.col("id") % 20 == 0, k=10, reach=60, share=0.1).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        assert [got[q][r + 1] for r in range(10)] == np.argsort(-s)[:10].tolist()


def test_queries_in_blocks(spark):
    x = np.random.default_rng(4).normal(size=(300, 6))
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    one, many = (sorted(map(tuple, multi_index.nearest(df, F.col("id") % 5 == 0, k=5, block=b).collect())) for b in (4096, 7))
    assert one == many and len(one) == 300
