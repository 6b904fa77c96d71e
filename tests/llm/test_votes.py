"""The neighbours' vote against a plain loop, and the bound on what is fitted."""

import math

import numpy as np
from pyspark.sql import functions as F

from trialweave.llm import neighbour_quality as nq


def plain_vote(v, voters, labels, k):
    mean = sum(labels) / len(labels)
    near = sorted(((sum(a * b for a, b in zip(v, w)), i) for i, w in enumerate(voters)), reverse=True)[:k]
    weights = [(max(s, 0.0) ** nq.POWER, labels[i]) for s, i in near]
    total = sum(w for w, _ in weights)
    return min(1.0, max(0.0, (sum(w * y for w, y in weights) + nq.PRIOR * mean) / (total + nq.PRIOR)))


def test_vote_equals_a_plain_loop():
    rng = np.random.default_rng(1)
    for voters_n, k in ((40, 15), (7, 15), (1, 3)):
        voters = rng.normal(size=(voters_n, 6))
        voters /= np.linalg.norm(voters, axis=1, keepdims=True)
        labels = rng.integers(0, 2, voters_n).astype(float)
        v = np.vstack([rng.normal(size=(25, 6)), np.zeros((1, 6))])
        v[:25] /= np.linalg.norm(v[:25], axis=1, keepdims=True)
        got = nq.vote(v, voters, labels, k)
        assert all(math.isclose(g, plain_vote(x.tolist(), voters.tolist(), labels.tolist(), k), abs_tol=1e-12) for g, x in zip(got, v))


def test_whole_scores_equal_a_plain_loop(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, " ".join(words[(i * 3 + j * (1 + i % 2)) % 8] for j in range(12)) + ("!" * (i % 2 * 3))) for i in range(60)]
    docs = spark.createDataFrame(rows + [(7, "zz another text of this id")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    weight, space, voters, marks = nq.fit(docs, labels, F.lit(True), labelled=30)
    assert len(marks) == 30 and len(voters) == 30
    got = {(r["id"], r["score"]) for r in nq.score(docs, (weight, space, voters, marks)).collect()}
    for i, t in rows:
        x = [a * b for a, b in zip(nq.term_counts(t.encode()).tolist(), weight.tolist())]
        p = [sum(x[d] * space[d][j] for d in range(nq.DIMS) if x[d]) for j in range(space.shape[1])]
        norm = math.sqrt(sum(a * a for a in p)) or 1.0
        want = plain_vote([a / norm for a in p], voters.tolist(), marks.tolist(), nq.VOTERS)
        assert any(j == i and math.isclose(s, want, abs_tol=1e-9) for j, s in got)
