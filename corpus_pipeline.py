"""From raw documents to packed sequences: quality rules, line dedup, near duplicates, repeated passages, packing.

Each stage works on all that the stage before it kept, and its result is written to the shared folder and read again.

* ``quality``: documents that break a base rule or leave the bounds of their language and source go.
* ``lines``: stretches of three lines, or of more than 50 words, that are there earlier are cut out; a document that has no word left by that goes.
* ``near_duplicates``: of documents linked by 80 % of their five-word shingles, the one with the smallest id stays.
* ``passages``: strings of 51 words that are there more than once are cut out; a document that has no word left by that goes.
* ``packing``: the pieces of the documents in sequences of 1024 tokens.

All but the last return the columns of ``documents``; ``n_chars`` follows the text. Null texts have no words, so the first stage drops them;
an empty table passes through every stage as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.llm import jaccard_join, line_dedup, packing, quality_rules, suffix_dedup, word_passages
from trialweave.llm.kit import WORD_CHAR, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs.select(*COLUMNS))


def _with_texts(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """Documents with their new texts; those emptied by a removal are gone."""
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    left = changed.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD_CHAR))
    return left.select(F.col("id").alias("doc_id"), "text", "keep.lang", "keep.source", n_chars.alias("n_chars"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_texts(docs, line_dedup.line_dedup(docs, keep=["lang", "source"]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_texts(docs, suffix_dedup.suffix_dedup(docs, keep=["lang", "source"], unit=word_passages.Words))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), added=True).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("passages", passages), ("packing", pack)]
#: Column generation can't be said in SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
