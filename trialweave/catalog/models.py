"""Registered queries: models trained on whole tables, sweeps and the baseline."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import models as J
from ..operators.trials import sequential_gate
from ..operators.vector_augment import Shape
from ..plans.session import fresh_path
from ..sources.tables import table
from .kit import u_sql, words_sql
from .prepare import image_rows
from .text import cutoff_sql, deletion_sql, swap_sql

QUERIES, SQL = {}, {}


def _docs(spark, d):
    return table(spark, d, "documents", "doc_id", "text", many_tasks=True)


def _bench(spark, d):
    return table(spark, d, "benchmark", "item_id", "text")


def _labelled(spark, d):
    return _docs(spark, d).join(table(spark, d, "labels", "doc_id", F.col("quality").alias("label")), "doc_id")


def j1_train_text_classifier(spark, d):
    """Logistic regression on augmented training texts; loss and accuracy on held-out ones."""
    cfg = {"pipeline": {"enabled": True, "text_augmentations": [{"name": "random_deletion", "enabled": True, "probability": 0.2}]}}
    _, _, metrics = J.train_text_classifier(_labelled(spark, d), config=cfg)
    return metrics


QUERIES["j1_train_text_classifier"] = j1_train_text_classifier


def _rounded(df, *keys):
    return df.select(*keys, "tokens", *[F.round(c, 6).alias(c) for c in ("loss", "perplexity", "bpb")])


def j2_score_lm(spark, d):
    return _rounded(J.score_lm(J.train_lm(_docs(spark, d)), _bench(spark, d)))


QUERIES["j2_score_lm"] = j2_score_lm
_out = "round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity, round(loss * 1.4426950408889634::DOUBLE / 4.0::DOUBLE, 6) AS bpb"


def lm_sql(train: str) -> str:
    return f"""t AS (SELECT unnest({words_sql('lower(text)')}) AS tok FROM {train}),
c AS (SELECT tok, count(*) AS c FROM t GROUP BY tok), f AS (SELECT sum(c) AS n, count(*) AS v FROM c),
e AS (SELECT unnest({words_sql('lower(text)')}) AS tok FROM benchmark),
l AS (SELECT count(*)::BIGINT AS tokens, avg(-ln((coalesce(c.c, 0) + 1.0::DOUBLE) / (f.n + f.v))) AS loss FROM e LEFT JOIN c ON c.tok = e.tok, f)"""


SQL["j2_score_lm"] = f"WITH {lm_sql('documents')} SELECT tokens, {_out} FROM l"


def j2_score_lm_bigram(spark, d):
    """Bigram model, scored per validation text."""
    return _rounded(J.score_lm(J.train_lm(_docs(spark, d), order=2, k=0.5), _bench(spark, d), keys=("item_id",)), "item_id")


QUERIES["j2_score_lm_bigram"] = j2_score_lm_bigram
_pairs = lambda t, k: (
    f"(SELECT {k} AS id, unnest(ws[1:len(ws) - 1]) AS ctx, unnest(ws[2:len(ws)]) AS tok FROM (SELECT {k}, {words_sql('lower(text)')} AS ws FROM {t}) WHERE len(ws) > 1)"
)
SQL["j2_score_lm_bigram"] = f"""
WITH c AS (SELECT ctx, tok, count(*) AS c FROM {_pairs('documents', 'doc_id')} GROUP BY ALL), x AS (SELECT ctx, sum(c) AS total FROM c GROUP BY ctx),
f AS (SELECT count(DISTINCT tok) AS v FROM c),
l AS (SELECT e.id AS item_id, count(*)::BIGINT AS tokens, avg(-ln((coalesce(c.c, 0) + 0.5::DOUBLE) / (coalesce(x.total, 0) + 0.5::DOUBLE * f.v))) AS loss
 FROM {_pairs('benchmark', 'item_id')} e LEFT JOIN c ON c.ctx = e.ctx AND c.tok = e.tok LEFT JOIN x ON x.ctx = e.ctx, f GROUP BY e.id)
SELECT item_id, tokens, {_out} FROM l"""


def j3_train_image_classifier(spark, d):
    """Centroids from nine tenths of the images, predictions for the others."""
    _, scored = J.train_image_classifier(image_rows(spark, d), Shape(8, 8))
    return scored.select("id", "label", "prediction")


QUERIES["j3_train_image_classifier"] = j3_train_image_classifier
_in = f"{u_sql(42, 'split', 'vec_id', 0)} < 0.9::DOUBLE"


def centroid_cte(where: str) -> str:
    return f"""x AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE {where}),
c AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(v) AS m FROM x GROUP BY ALL) GROUP BY label)"""


_dist = "list_sum(list_transform(list_zip(e.embedding, c.c), lambda z: (z[2] - z[1]::DOUBLE) * (z[2] - z[1]::DOUBLE)))"
SQL["j3_train_image_classifier"] = f"""
WITH {centroid_cte(_in)},
s AS (SELECT e.vec_id, e.label, c.label AS guess, {_dist} AS dist FROM embeddings e, c WHERE NOT ({_in}))
SELECT vec_id AS id, label, guess AS prediction FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, guess) = 1"""

CANDIDATES = [
    {"pipeline": {"enabled": True, "text_augmentations": [{"name": "random_deletion", "enabled": True, "probability": 0.3}]}},
    {"pipeline": {"enabled": True, "text_augmentations": [{"name": "token_cutoff", "enabled": True, "probability": 0.6, "cutoff_ratio": 0.4}]}},
    {"pipeline": {"enabled": False}},
    {"pipeline": {"enabled": True, "text_augmentations": [{"name": "random_swap", "enabled": True, "probability": 0.5}]}},
]


def j4_trial_sweep(spark, d):
    out = J.trial_sweep(_docs(spark, d), _bench(spark, d), CANDIDATES)
    return out.withColumn("loss", F.round("loss", 6))


QUERIES["j4_trial_sweep"] = j4_trial_sweep
_branches = [
    deletion_sql("documents", "0.random_deletion", 0.3, 0.3),
    cutoff_sql("documents", "0.token_cutoff", 0.6, 0.4),
    "documents",
    swap_sql("documents", "0.random_swap", 0.5),
]
_sweep = "\nUNION ALL ".join(f"SELECT {i}::BIGINT AS trial_id, unnest({words_sql('lower(text)')}) AS tok FROM {b}" for i, b in enumerate(_branches))
SWEEP_CTE = f"""t AS ({_sweep}), c AS (SELECT trial_id, tok, count(*) AS c FROM t GROUP BY ALL),
f AS (SELECT trial_id, sum(c)::BIGINT AS train_tokens, count(*)::BIGINT AS vocabulary FROM c GROUP BY trial_id),
e AS (SELECT unnest({words_sql('lower(text)')}) AS tok FROM benchmark), w AS (SELECT f.*, e.tok FROM f, e),
sweep AS (SELECT w.trial_id, any_value(train_tokens) AS train_tokens, any_value(vocabulary) AS vocabulary,
 avg(-ln((coalesce(c.c, 0) + 1.0::DOUBLE) / (train_tokens + vocabulary))) AS loss FROM w LEFT JOIN c ON c.trial_id = w.trial_id AND c.tok = w.tok GROUP BY w.trial_id)"""
SQL["j4_trial_sweep"] = f"WITH {SWEEP_CTE} SELECT trial_id, train_tokens, vocabulary, round(loss, 6) AS loss FROM sweep"


def candidate_table(spark, n):
    """Candidates as a table: deletion and swapping at several strengths."""
    made = []
    for i in range(n):
        name = "random_swap" if i % 4 == 3 else "random_deletion"
        made.append((i, json.dumps({"pipeline": {"enabled": i % 4 != 2, "text_augmentations": [{"name": name, "enabled": True, "probability": 0.05 + 0.01 * i}]}})))
    return spark.createDataFrame(made, "trial_id bigint, config string")


def j4_sweep_table(spark, d):
    """Twelve candidates of a table, one pass over the documents."""
    return J.trial_sweep(_docs(spark, d), _bench(spark, d), candidate_table(spark, 12)).withColumn("loss", F.round("loss", 6))


QUERIES["j4_sweep_table"] = j4_sweep_table
_many = "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS trial_id, unnest({words_sql('lower(text)')}) AS tok FROM "
    + ("documents" if i % 4 == 2 else swap_sql("documents", "0.random_swap", 0.05 + 0.01 * i) if i % 4 == 3 else deletion_sql("documents", "0.random_deletion", 0.05 + 0.01 * i, 0.05 + 0.01 * i))
    for i in range(12)
)
SQL["j4_sweep_table"] = f"WITH {SWEEP_CTE.replace(_sweep, _many)} SELECT trial_id, train_tokens, vocabulary, round(loss, 6) AS loss FROM sweep"


def j4_sweep_and_gate(spark, d):
    """The sweep's results, held against the baseline in trial order."""
    docs, bench = _docs(spark, d), _bench(spark, d)
    trials = J.trial_sweep(docs, bench, CANDIDATES).select(
        F.lit("lm").alias("experiment"), "trial_id", F.round("loss", 6).alias("primary_metric")
    )
    base = J.baseline_trial(docs, bench).select(F.lit("lm").alias("experiment"), F.round("primary_metric", 6).alias("baseline"))
    return sequential_gate(trials, baselines=base, threshold=0.0001).select("trial_id", "primary_metric", "baseline", "accepted", "fails")


QUERIES["j4_sweep_and_gate"] = j4_sweep_and_gate
_hit = "(coalesce(g.best, s.baseline) - s.primary_metric) / abs(coalesce(g.best, s.baseline)) >= 0.0001::DOUBLE"
SQL["j4_sweep_and_gate"] = f"""
WITH RECURSIVE {SWEEP_CTE},
b AS (SELECT round(loss, 6) AS baseline FROM sweep WHERE trial_id = 2),
s AS (SELECT trial_id, round(loss, 6) AS primary_metric, baseline FROM sweep, b),
g AS (SELECT -1::BIGINT AS trial_id, NULL::DOUBLE AS primary_metric, NULL::DOUBLE AS baseline, NULL::DOUBLE AS best, false AS accepted, 0::BIGINT AS fails
 UNION ALL SELECT s.trial_id, s.primary_metric, s.baseline, CASE WHEN {_hit} THEN s.primary_metric ELSE g.best END, {_hit}, CASE WHEN {_hit} THEN 0 ELSE g.fails + 1 END
 FROM g JOIN s ON s.trial_id = g.trial_id + 1)
SELECT trial_id, primary_metric, baseline, accepted, fails FROM g WHERE trial_id >= 0"""


def j4_classifier_sweep(spark, d):
    """Text classifiers trained on differently augmented texts, a few at a time."""
    return J.classifier_sweep(_labelled(spark, d), CANDIDATES)


QUERIES["j4_classifier_sweep"] = j4_classifier_sweep


def j5_predict(spark, d):
    rows = image_rows(spark, d)
    model = J.train_centroids(rows)
    out = J.predict_centroids(rows, model)
    return out.select("id", "prediction", F.round("probability", 6).alias("probability"))


QUERIES["j5_predict"] = j5_predict
SQL["j5_predict"] = f"""
WITH {centroid_cte('true')}, s AS (SELECT e.vec_id AS id, c.label AS guess, -{_dist} AS logit FROM embeddings e, c)
SELECT id, arg_min(guess, struct_pack(a := -logit, b := guess)) AS prediction, round(1 / sum(exp(logit - top)), 6) AS probability
FROM (SELECT *, max(logit) OVER (PARTITION BY id) AS top FROM s) GROUP BY id"""


def j6_save_load_lm(spark, d):
    path = fresh_path(spark, "lm")
    J.save_lm(J.train_lm(_docs(spark, d)), path)
    return _rounded(J.score_lm(J.load_model(spark, path), _bench(spark, d)))


QUERIES["j6_save_load_lm"] = j6_save_load_lm
SQL["j6_save_load_lm"] = SQL["j2_score_lm"]


def j6_save_load_classifier(spark, d):
    rows = _labelled(spark, d)
    model, _, _ = J.train_text_classifier(rows)
    path = fresh_path(spark, "classifier")
    J.save_classifier(model, path)
    from ..functions.texts import words

    words_of = rows.select("doc_id", words(F.lower(F.col("text"))).alias("words"))
    return J.load_model(spark, path).transform(words_of).select("doc_id", F.col("prediction").cast("int").alias("prediction"))


QUERIES["j6_save_load_classifier"] = j6_save_load_classifier


def j6_save_load_centroids(spark, d):
    rows = image_rows(spark, d)
    path = fresh_path(spark, "centroids")
    J.save_centroids(J.train_centroids(rows), path)
    out = J.predict_centroids(rows, J.load_model(spark, path))
    return out.select("id", "prediction", F.round("probability", 6).alias("probability"))


QUERIES["j6_save_load_centroids"] = j6_save_load_centroids
SQL["j6_save_load_centroids"] = SQL["j5_predict"]


def j8_baseline(spark, d):
    out = J.baseline_trial(_docs(spark, d), _bench(spark, d))
    return out.select("trial_id", "decision", F.round("primary_metric", 6).alias("primary_metric"), "tokens")


QUERIES["j8_baseline"] = j8_baseline
SQL["j8_baseline"] = f"WITH {lm_sql('documents')} SELECT -1::BIGINT AS trial_id, 'baseline' AS decision, round(loss, 6) AS primary_metric, tokens FROM l"
