"""Quality scores by the votes of the nearest labelled documents in a latent semantic space.

Texts become counts of hashed byte trigrams and of a few word-level terms (repeated words, words in capitals, words that end in symbols), damped, weighted
by inverse document frequency and projected on the leading singular vectors. Space, frequencies and voters are fitted on at most ``labelled``
labelled rows, chosen by the hash of their id: that bound is the only thing that does not grow with the corpus, and it bounds what is broadcast
(``labelled * RANK`` numbers). Every document is compared with all voters by products of blocks; the ``k`` most similar vote for their
label, weighted by a power of the cosine, with a small share of the voters' mean.

Labels are learnt where ``learn`` holds. Defined results: null and empty texts, which have no direction, get the voters' mean; labels that are null are
left out; without any voters every score is 0.5; repeated rows get equal scores; an id that is labelled twice votes twice, with
the smallest of the texts it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import materialize, read

DIMS, RANK, VOTERS, LABELLED, POWER, PRIOR = 2048, 64, 15, 4000, 12, 0.02
WORD_TERMS = 4
_SYMBOLS = tuple(b"#*$%&|<>!")


def term_counts(text: bytes) -> np.ndarray:
    """Damped counts of a text's terms, per thousand."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    out = np.zeros(DIMS)
    if len(data) >= 3:
        h = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out = np.bincount((h >> np.uint32(16)) % np.uint32(DIMS - WORD_TERMS), minlength=DIMS).astype(float)
    words = text.split()
    n = max(len(words), 1)
    out[DIMS - 4] = 4 * sum(map(eq, words, words[1:]))
    out[DIMS - 3] = 2 * sum(map(bytes.isupper, words))
    out[DIMS - 2] = 2 * sum(w[-1] in _SYMBOLS for w in words)
    out[DIMS - 1] = 2 * (len(words) - len(set(words)))
    out[: DIMS - WORD_TERMS] *= 1000.0 / max(len(data), 1)
    out[DIMS - WORD_TERMS :] *= 1000.0 / n
    return np.log1p(out)


def fit_space(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Term weights and the projection on the leading singular vectors."""
    x = np.stack([term_counts(t) for t in texts])
    weight = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 0.1
    weight[DIMS - WORD_TERMS :] = 1.0
    x *= weight
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.where(norm > 0, norm, 1)
    values, vectors = np.linalg.eigh(x.T @ x)
    return weight, vectors[:, ::-1][:, :RANK].copy()


def project(texts: list[bytes], weight: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Directions of texts in the space; zeros for those without any."""
    x = np.stack([term_counts(t) for t in texts]) * weight
    v = x @ space
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    v /= np.where(norm > 0, norm, 1)
    v[(x == 0).all(axis=1)] = 0
    return v


def vote(v: np.ndarray, voters: np.ndarray, labels: np.ndarray, k: int = VOTERS) -> np.ndarray:
    """Scores from exact cosines with all voters."""
    mean = labels.mean()
    near = v @ voters.T
    k = min(k, len(voters))
    at = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, at, axis=1), 0) ** POWER
    return np.clip(((weight * labels[at]).sum(axis=1) + PRIOR * mean) / (weight.sum(axis=1) + PRIOR), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, labelled: int = LABELLED) -> tuple | None:
    """The model: weights, space, voters and their labels. ``labels``: ``doc_id`` and ``quality``; ``learn``: condition on ``doc_id``."""
    chosen = labels.filter(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("label"))
    chosen = materialize(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(labelled), "quality-voters")
    # one text of an id, however often it is there, so that the sample's bound is one on texts as well
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text")).join(chosen, "doc_id")

    def learn_space(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "label"], kind="stable")
        texts = [t.encode() for t in group["text"]]
        weight, space = fit_space(texts)
        voters = np.vstack([project(texts[i : i + 256], weight, space) for i in range(0, len(texts), 256)])
        return pd.DataFrame({"weight": [weight.tobytes()], "space": [space.tobytes()], "voters": [voters.tobytes()], "labels": [group["label"].to_numpy(float).tobytes()]})

    # the bounded sample is fitted in one task
    model = rows.groupBy(F.lit(0).alias("all")).applyInPandas(learn_space, "weight binary, space binary, voters binary, labels binary").first()
    if model is None:
        return None
    weight, space, voters, marks = (np.frombuffer(b, np.float64) for b in model)
    return weight, space.reshape(DIMS, -1), voters.reshape(len(marks), -1), marks


def score(docs: DataFrame, model: tuple | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` of every row."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = own.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            scores = np.full(batch.num_rows, 0.5)
            if shared.value is not None:
                weight, space, voters, labels = shared.value
                for at in range(0, batch.num_rows, 256):
                    block = [t.as_py() for t in texts.slice(at, 256)]
                    scores[at : at + len(block)] = vote(project(block, weight, space), voters, labels)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], names=["id", "score"])

    return own.mapInArrow(run, f"id {id_type}, score double")


def remainder(id_: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def op4_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    model = fit(docs, read(spark, folder, "labels", "doc_id", "quality"), remainder(F.col("doc_id")) != 1)
    out = score(docs, model)
    return out.select(F.col("id").alias("doc_id"), (remainder(F.col("id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op4_neighbour_quality": op4_neighbour_quality}
ORACLES: dict[str, str] = {}
