"""Personal-data and license screening."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import u
from ..functions.texts import BLANKS, words
from ..plans.lookup import salted_lookup

# What is recognised, by which pattern, with which score. Patterns use ASCII
# classes only and mean the same in Java and RE2. A score of None is decided by a check.
PII_RULES = (
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0.95),
    ("PHONE_NUMBER", r"(?:\+1 )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}|(?:\+1[ .-])?\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b", 0.75),
    ("US_SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.85),
    ("CREDIT_CARD", r"\b[0-9]{13,19}\b", None),
    (
        "IP_ADDRESS",
        r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\b",
        0.8,
    ),
    ("IBAN_CODE", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", None),
    ("US_PASSPORT", r"\b[A-Z]?[0-9]{8,9}\b", None),
    ("US_DRIVER_LICENSE", r"\b[A-Z][0-9]{7,12}\b", None),
)
PERSON_SCORE = 0.75
DEFAULT_THRESHOLD = 0.7
CONTEXT_WORDS = {"US_PASSPORT": ("passport",), "US_DRIVER_LICENSE": ("driver", "license")}
CONTEXT_LENGTH = 50
FINDING = "array<struct<type:string,score:double,start:bigint,end:bigint,text:string>>"


def luhn_ok(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def iban_ok(code: Column) -> Column:
    n = F.length(code)
    moved = F.concat(F.substr(code, F.lit(5), n), F.substr(code, F.lit(1), F.lit(4)))

    def step(acc, i):
        v = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(v < 65, (acc * 10 + v - 48) % 97).otherwise((acc * 100 + v - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) == 1


def _score(kind: str, fixed, found: Column, before: Column) -> Column:
    if fixed is not None:
        return F.lit(float(fixed))
    if kind == "CREDIT_CARD":
        return F.when(luhn_ok(found), 1.0).otherwise(0.3)
    if kind == "IBAN_CODE":
        return F.when(iban_ok(found), 1.0).otherwise(0.3)
    near = F.lit(False)
    for w in CONTEXT_WORDS[kind]:
        near = near | F.lower(before).contains(w)
    return F.when(near, 0.8).otherwise(0.3)


#: Numbers that are summed up at once.
_SUM_BLOCK = 128


def _let(value: Column, body) -> Column:
    """Binds a value by a one-element array, so that it is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums_before(numbers: Column) -> Column:
    """The sum of all numbers before each one: by blocks, so the work is in proportion to the numbers."""
    add = lambda a, x: a + x

    def spread(n: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(n) / F.lit(_SUM_BLOCK)).cast("int"))
        sums = F.transform(blocks, lambda b: F.aggregate(F.slice(n, b * _SUM_BLOCK + 1, F.lit(_SUM_BLOCK)), F.lit(0), add))
        heads = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        block = lambda i: F.floor(i / F.lit(_SUM_BLOCK)).cast("int")
        return _let(
            heads,
            lambda h: F.transform(n, lambda _, i: F.get(h, block(i)) + F.aggregate(F.slice(n, block(i) * _SUM_BLOCK + 1, F.pmod(i, F.lit(_SUM_BLOCK))), F.lit(0), add)),
        )

    return _let(numbers, spread)


def _matches(text: Column, kind: str, pattern: str, fixed) -> Column:
    """Findings of one rule with character offsets. The text is cut at the matches; running sums of the
    lengths of pieces and matches give the offsets, and the pieces before a match its context."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
    cut = F.struct(found.alias("found"), pieces.alias("pieces"), _sums_before(lengths).alias("at"))

    def finding(c: Column, m: Column, i: Column) -> Column:
        start = F.get(c["at"], i) + F.length(F.get(c["pieces"], i))
        first = F.greatest(i - CONTEXT_LENGTH, F.lit(0))  # every match has a character at least
        parts = F.zip_with(F.slice(c["pieces"], first + 1, i - first), F.slice(c["found"], first + 1, i - first), lambda p, m: F.concat(p, m))
        before = F.right(F.concat(F.array_join(parts, ""), F.get(c["pieces"], i)), F.lit(CONTEXT_LENGTH))
        return F.struct(
            F.lit(kind).alias("type"),
            _score(kind, fixed, m, before).alias("score"),
            start.cast("bigint").alias("start"),
            (start + F.length(m)).cast("bigint").alias("end"),
            m.alias("text"),
        )

    findings = _let(cut, lambda c: F.transform(c["found"], lambda m, i: finding(c, m, i)))
    return F.when(text.rlike(pattern), findings).otherwise(F.array().cast(FINDING))


def pii_findings(text: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """All findings of the pattern rules in one text, as an array; no rule needs a text
    without digits and without ``@``."""
    every = F.flatten(F.array(*[_matches(text, *r) for r in PII_RULES]))
    kept = F.filter(every, lambda f: f["score"] >= F.lit(float(threshold)))
    return F.when(text.rlike("[0-9@]"), kept).otherwise(F.array().cast(FINDING))


def pii_scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = DEFAULT_THRESHOLD,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """One row per finding: (key, type, score, start, end, text); start counts from 0, end is
    exclusive. ``gazetteer`` (given, family) adds persons."""
    out = df.select(key, F.explode(pii_findings(F.col(text), threshold)).alias("f")).select(key, "f.*")
    if gazetteer is not None and threshold <= PERSON_SCORE:
        out = out.unionByName(person_scan(df, gazetteer, key, text))
    return out


#: Bits of the filter of names: about ten a name, between these bounds, so at most 16 MB are handed to the tasks.
NAME_BITS = (1 << 16, 1 << 27)


def _pair_hashes(given, family) -> np.ndarray:
    """Three hashes of each pair of words, the same in every process."""
    return _mixed(*(pd.util.hash_array(np.asarray(x, object), categorize=False) for x in (given, family)))


def _mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    both = one * np.uint64(0x9E3779B97F4A7C15) ^ (two + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
    return np.stack([both >> np.uint64(s) ^ both << np.uint64(64 - s) for s in (11, 27, 43)])


def name_filter(names: DataFrame) -> np.ndarray:
    """A Bloom filter of (given, family): bits set by tasks and united in a tree."""
    wanted = names.count() * 10
    size = min(max(1 << max(wanted - 1, 1).bit_length(), NAME_BITS[0]), NAME_BITS[1])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            given, family = (batch.column(c).to_pylist() for c in ("given", "family"))
            if given:
                bits[(_pair_hashes(given, family) % np.uint64(size)).ravel().astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    parts = names.mapInArrow(fill, "bits binary").rdd.map(lambda r: np.frombuffer(bytes(r["bits"]), np.uint8))
    if parts.getNumPartitions() == 0:
        return np.zeros(size // 8, np.uint8)
    return parts.treeReduce(np.bitwise_or)


def person_scan(df: DataFrame, gazetteer: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Two neighbouring words that are listed as given and family name.

    Neighbours are tested where the text is read, against a Bloom filter of the names; only those that pass it, with their text, are joined with the names. Offsets are worked
    out for the hits only."""
    spark = df.sparkSession
    names = gazetteer.select("given", "family").filter("given IS NOT NULL AND family IS NOT NULL").distinct()
    known = spark.sparkContext.broadcast(name_filter(names))
    kind = dict(df.dtypes)[key]

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        size = np.uint64(len(bits) * 8)
        for batch in batches:
            column = batch.column("_w")
            flat = column.flatten().to_pandas()
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            given, family = flat.to_numpy(object)[:-1], flat.to_numpy(object)[1:]
            hit = row[1:] == row[:-1]
            if len(given):
                codes, words_ = pd.factorize(flat)  # every distinct word is hashed once
                hashed = pd.util.hash_array(np.asarray(words_, object), categorize=False)[codes]
                for at in _mixed(hashed[:-1], hashed[1:]):
                    at = at % size
                    hit = hit & (bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            found = np.flatnonzero(hit)
            take = pa.array(row[found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(take), pa.array(pos[found], pa.int32()), pa.array(given[found], pa.string()), pa.array(family[found], pa.string()), batch.column(text).take(take)],
                names=[key, "pos", "given", "family", text],
            )

    near = df.select(key, text, words(F.col(text)).alias("_w")).mapInArrow(test, f"`{key}` {kind}, pos int, given string, family string, `{text}` string")
    rows = salted_lookup(near, names, ["given", "family"], [key, "pos"], how="inner")
    w, blanks = F.col("_w"), F.col("_b")
    rows = rows.withColumn("_w", words(F.col(text))).withColumn("_b", F.regexp_extract_all(F.col(text), F.lit(BLANKS), F.lit(0)))
    rows = rows.withColumn("_lead", F.col(text).rlike("^" + BLANKS).cast("int"))
    length = lambda acc, s: acc + F.length(s)
    start = F.aggregate(F.slice(w, F.lit(1), F.col("pos")), F.lit(0), length) + F.aggregate(
        F.slice(blanks, F.lit(1), F.col("pos") + F.col("_lead")), F.lit(0), length
    )
    span = (
        F.length(F.get(w, F.col("pos")))
        + F.length(F.get(blanks, F.col("pos") + F.col("_lead")))
        + F.length(F.get(w, F.col("pos") + 1))
    )
    return rows.select(
        key,
        F.lit("PERSON").alias("type"),
        F.lit(PERSON_SCORE).alias("score"),
        start.cast("bigint").alias("start"),
        (start + span).cast("bigint").alias("end"),
        F.substr(F.col(text), start + 1, span).alias("text"),
    )


def pii_report(df: DataFrame, findings: DataFrame, key: str = "doc_id", shown: int = 10, issues: int = 5) -> DataFrame:
    """One row: safe, total_scanned, pii_count, the first findings and the first messages."""
    order = [F.col(key), F.col("start"), F.col("type")]
    top = findings.orderBy(*order).limit(shown).select(F.struct(key, "start", "type", "score", "end", "text").alias("f"))
    top = top.agg(F.array_sort(F.collect_list("f")).alias("pii_found"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    line = lambda f: F.format_string("Found %s (score=%.2f): '%s'", f["type"], f["score"], f["text"])
    out = findings.agg(F.count(F.lit(1)).alias("pii_count"))
    out = out.withColumn("total_scanned", total.scalar()).withColumn("pii_found", top.scalar())
    return out.select(
        (F.col("pii_count") == 0).alias("safe"), "total_scanned", "pii_count", "pii_found",
        F.transform(F.slice("pii_found", 1, issues), line).alias("issues"),
    )


def sample_for_scan(df: DataFrame, key: str = "doc_id", sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """All rows unless a sample size is given; then that many, without replacement."""
    if sample_size is None:
        return df
    return df.orderBy(u(seed, "scan_sample", F.col(key), 0), F.col(key)).limit(sample_size)


# Fixed value: the message for a config that mixes in external sources.
MIXING_ISSUE = (
    "Data mixing with external sources is enabled. PII scanning will run on mixed data during training."
)


def mixing_risk(configs: DataFrame, config: str = "config") -> DataFrame:
    """Adds ``safe`` and ``issue``: a config that mixes in external sources is flagged."""
    j = F.col(config)
    enabled = F.get_json_object(j, "$.pipeline.data_mixing.enabled") == "true"
    sources = F.from_json(F.get_json_object(j, "$.pipeline.data_mixing.sources"), "array<string>")
    risky = F.coalesce(enabled & (F.size(sources) > 0), F.lit(False))
    return configs.withColumn("safe", ~risky).withColumn("issue", F.when(risky, F.lit(MIXING_ISSUE)))


# -- licenses ---------------------------------------------------------------------------

# Licenses compatible with training and augmentation.
PERMISSIVE_LICENSES = (
    "mit",
    "apache-2.0",
    "bsd-2-clause",
    "bsd-3-clause",
    "cc-by-4.0",
    "cc-by-sa-4.0",
    "cc0-1.0",
    "unlicense",
    "openrail",
    "openrail++",
    "bigscience-openrail-m",
    "creativeml-openrail-m",
    "bigscience-bloom-rail-1.0",
    "llama2",
    "llama3",
    "gemma",
)
# Licenses for research only.
RESEARCH_ONLY_LICENSES = ("cc-by-nc-4.0", "cc-by-nc-sa-4.0", "cc-by-nc-nd-4.0")
# Resources without a license record.
UNLICENSED_NAMES = ("custom", "cifar10", "cifar100")
# How license statements are worded in texts.
LICENSE_STATEMENTS = (
    ("apache-2.0", r"Licensed under the Apache License, Version 2\.0"),
    ("mit", r"Released under the MIT License"),
    ("gpl-3.0", r"licensed under the GNU General Public License, version 3"),
    ("cc-by-nc-4.0", r"Licensed under CC BY-NC 4\.0"),
)
# Statements that name one of the licenses above, and tags that name any.
NAMED_LICENSE = r"(?i)(?:licensed|released|distributed) under (?:the )?([a-z0-9][a-z0-9.+-]*) licen[cs]e"
LICENSE_TAG = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*)"
# Fixed value: the message for a config that fetches from the web.
WEB_ISSUE = (
    "Web fetcher is enabled. Ensure fetched data sources have compatible licenses before using in training."
)


def license_class(name: Column) -> Column:
    n = F.lower(F.trim(name))
    return (
        F.when(n.isNull(), F.lit(None).cast("string"))
        .when(n.isin(*PERMISSIVE_LICENSES), "permissive")
        .when(n.isin(*RESEARCH_ONLY_LICENSES), "research_only")
        .otherwise("other")
    )


def license_compatible(name: Column) -> Column:
    """Unknown licenses raise no objection."""
    return F.coalesce(license_class(name) != "other", F.lit(True))


def license_mentions(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per license stated in a text: by a known sentence, by its name, or by a tag."""
    found = lambda p: F.transform(F.regexp_extract_all(F.col(text), F.lit(p), F.lit(1)), lambda n: F.regexp_replace(F.lower(n), r"\.$", ""))
    hits = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), F.lit(i)) for i, p in LICENSE_STATEMENTS]))
    named = F.filter(found(NAMED_LICENSE), lambda n: n.isin(*PERMISSIVE_LICENSES, *RESEARCH_ONLY_LICENSES))
    return df.select(key, *keep, F.explode(F.array_distinct(F.concat(hits, named, found(LICENSE_TAG)))).alias("license"))


def license_violations(mentions: DataFrame) -> DataFrame:
    return mentions.filter(~license_compatible(F.col("license")))


def license_report(mentions: DataFrame, by: str, groups: DataFrame | None = None) -> DataFrame:
    """Per group: passed, its licenses and a message per incompatible one. Those of ``groups`` without a mention have passed."""
    rows = mentions.select(by, "license")
    if groups is not None:
        rows = rows.unionByName(groups.select(by, F.lit(None).cast("string").alias("license")))
    distinct = rows.distinct()
    message = F.when(
        ~license_compatible(F.col("license")),
        F.format_string(
            "Dataset '%s' has license '%s' which may restrict augmentation/modification.", F.col(by), F.col("license")
        ),
    )
    # at most one entry per known license statement
    return distinct.groupBy(by).agg(
        F.bool_and(license_compatible(F.col("license"))).alias("passed"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
        F.array_sort(F.collect_set(message)).alias("issues"),
    )


def check_licenses(configs: DataFrame, licenses: DataFrame, key: str = "config_id") -> DataFrame:
    """(key, passed, model_license, dataset_license, issues) for configs with columns
    ``model``, ``dataset`` and ``web_fetcher``; ``licenses`` holds (name, license)."""
    known = licenses.select("name", F.lower("license").alias("license")).filter(~F.col("name").isin(*UNLICENSED_NAMES))
    as_model = known.select(F.col("name").alias("model"), F.col("license").alias("model_license"))
    as_data = known.select(F.col("name").alias("dataset"), F.col("license").alias("dataset_license"))
    joined = salted_lookup(salted_lookup(configs, as_model, ["model"], [key]), as_data, ["dataset"], [key])
    issues = F.array_compact(
        F.array(
            F.when(
                ~license_compatible(F.col("model_license")),
                F.format_string(
                    "Model '%s' has license '%s' which may restrict fine-tuning.", F.col("model"), F.col("model_license")
                ),
            ),
            F.when(
                ~license_compatible(F.col("dataset_license")),
                F.format_string(
                    "Dataset '%s' has license '%s' which may restrict augmentation/modification.",
                    F.col("dataset"), F.col("dataset_license"),
                ),
            ),
            F.when(F.col("web_fetcher"), F.lit(WEB_ISSUE)),
        )
    )
    return joined.withColumn("issues", issues).select(
        key, (F.size("issues") == 0).alias("passed"), "model_license", "dataset_license", "issues"
    )


def safety_gate(pii: DataFrame, licenses: DataFrame, key: str = "config_id", on_error: str = "pass") -> DataFrame:
    """(key, safe): both checks must hold. A check without a result counts as passed, or as
    failed with ``on_error='fail'``."""
    missing = F.lit(on_error == "pass")
    both = pii.select(key, F.col("safe").alias("_a")).join(licenses.select(key, F.col("passed").alias("_b")), key, "full")
    return both.select(key, (F.coalesce("_a", missing) & F.coalesce("_b", missing)).alias("safe"))
