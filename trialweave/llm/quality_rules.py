"""Quality rules whose thresholds follow the data.

Every document is measured once. The measures are whole numbers, and each (language, source) keeps a quantile sketch of
each measure: counts by log-linear buckets, 32 to a power of two, so a quantile is off by 3 % at most. Sketches merge by
adding counts, in any order and with the same result, which is how a group that is too small takes the sketch of its language,
and a language that is too small that of the corpus. A measure may lie ``reach`` times the distance of the quartiles
outside of them; ``spread`` is the least distance counted, so that a measure which is nearly always 0 has room.

Defined results: a null text has no words; null language or source is a group of its own; equal rows are judged alike;
an empty table gives an empty one. Column functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import BLANKS, WORD_CHAR, let, materialize, null_safe, read

WINDOW = 8


@dataclass(frozen=True)
class Measure:
    """A whole number from the counts, with the least quartile distance, and whether small values count as odd, too."""

    name: str
    sql: str
    spread: int
    both: bool = False


MEASURES = (
    Measure("word_length", "100 * word_chars div greatest(n_words, 1)", 40, True),
    Measure("symbols", "1000 * n_symbols div greatest(n_words, 1)", 20),
    Measure("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 95),
    Measure("stutters", "1000 * n_stutters div greatest(n_words, 1)", 20),
    Measure("repeated_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 160),
    Measure("capitals", "1000 * n_capitals div greatest(word_chars, 1)", 15),
    Measure("shouts", "1000 * n_shouts div greatest(n_words, 1)", 15),
)
REACH = 3
MIN_GROUP = 200


def count_matches(text: Column, pattern: str) -> Column:
    """Characters of a class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of eight words found twice or more, from the hashes of the words."""

    def count(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(pairs: Column) -> Column:
            twice = F.filter(
                pairs, lambda p, i: F.coalesce((F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"]), F.lit(False))
            )
            # or is null only when one side is missing and the other differs
            starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
            return let(
                starts,
                lambda s: F.aggregate(
                    F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)))),
                    F.lit(0).cast("long"),
                    lambda a, x: a + x,
                ),
            )

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(ordered, covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, count))


def counts(text: Column) -> Column:
    """The base counts of a text, as one struct."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            let(
                F.transform(w, lambda x: F.xxhash64(x)),
                lambda h: F.struct(
                    repeated_words(h).alias("repeated"), F.size(F.filter(h, lambda x, i: F.get(h, i - 1) == x)).cast("long").alias("stutters")
                ),
            ).alias("h"),
        ),
    )
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        count_matches(text, r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        count_matches(text, r"\p{Lu}").cast("long").alias("n_capitals"),
        count_matches(text, r"!").cast("long").alias("n_shouts"),
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One slim row per document: id, hash of the text, language, source, the counts and ``base_failed``."""
    found = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_h"),
        F.col(lang_col).alias("_lang"),
        F.col(source_col).alias("_source"),
        counts(F.col(text_col)).alias("_c"),
    )
    flat = found.select(
        "_id",
        "_h",
        "_lang",
        "_source",
        F.col("_c.w.n").alias("n_words"),
        F.col("_c.w.chars").alias("word_chars"),
        F.col("_c.n_symbols").alias("n_symbols"),
        F.col("_c.l.dup").alias("n_dup_lines"),
        F.col("_c.w.h.repeated").alias("n_repeat_words"),
        F.col("_c.l.n").alias("n_lines"),
        F.col("_c.w.h.stutters").alias("n_stutters"),
        F.col("_c.n_capitals").alias("n_capitals"),
        F.col("_c.n_shouts").alias("n_shouts"),
    )
    return flat.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def bucket(value: Column) -> Column:
    """Log-linear bucket of a whole number of at least 0."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32 + F.call_function("shiftright", value, shift)).cast("long")


def bucket_floor(b: Column) -> Column:
    """The least value of a bucket."""
    shift = F.greatest(F.floor(b / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", b - shift * F.lit(32).cast("long"), shift)


def sketch(measured: DataFrame) -> DataFrame:
    """Counts by language, source, measure and bucket; sketches of parts of a corpus merge by ``merge``."""
    each = F.array(*[F.struct(F.lit(m.name).alias("measure"), F.expr(m.sql).cast("long").alias("value")) for m in MEASURES])
    rows = measured.select("_lang", "_source", F.inline(each))
    return rows.groupBy("_lang", "_source", "measure", bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    first, *rest = sketches
    for s in rest:
        first = first.unionByName(s)
    return first.groupBy("_lang", "_source", "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketched: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles and number of documents of each group of sketches, merged to the columns of ``by``."""
    merged = sketched.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = W.partitionBy(*by, "measure")
    up_to = w.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    ranked = merged.withColumns({"below": F.sum("n").over(up_to), "total": F.sum("n").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))})
    return ranked.groupBy(*by, "measure").agg(
        F.max("total").alias("total"),
        *[bucket_floor(F.min(F.when(F.col("below") * 100 >= F.col("total") * q, F.col("bucket")))).alias(f"q{q}") for q in (25, 75)],
    )


def thresholds(sketched: DataFrame, reach: int = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per language and source with the bounds of each measure (``lo_`` and ``hi_``)."""
    own = quartiles(sketched, ["_lang", "_source"])
    lang = quartiles(sketched, ["_lang"]).select(F.col("_lang").alias("_l"), F.col("measure").alias("_m"), *[F.col(c).alias(f"l_{c}") for c in ("total", "q25", "q75")])
    # the corpus has one row per measure; keyed by it
    corpus = quartiles(sketched, []).select(F.col("measure").alias("_cm"), *[F.col(c).alias(f"c_{c}") for c in ("q25", "q75")])
    all_ = own.join(lang, own["_lang"].eqNullSafe(lang["_l"]) & (own["measure"] == lang["_m"])).join(corpus, F.col("measure") == F.col("_cm"))
    taken = {q: F.when(F.col("total") >= min_group, F.col(q)).when(F.col("l_total") >= min_group, F.col(f"l_{q}")).otherwise(F.col(f"c_{q}")) for q in ("q25", "q75")}
    all_ = all_.select("_lang", "_source", "measure", taken["q25"].alias("a"), taken["q75"].alias("b"))
    bounds = []
    for m in MEASURES:
        room = reach * F.greatest(F.col("b") - F.col("a"), F.lit(m.spread))
        bounds.append(F.max(F.when(F.col("measure") == m.name, F.col("b") + room)).alias(f"hi_{m.name}"))
        if m.both:
            bounds.append(F.max(F.when(F.col("measure") == m.name, F.col("a") - room)).alias(f"lo_{m.name}"))
    return all_.groupBy("_lang", "_source").agg(*bounds)


def judge(measured: DataFrame, bounds: DataFrame) -> DataFrame:
    """The measured rows with ``kept``: no base rule failed and every measure within its group's bounds.

    The bounds are read from a stored table, so their size is known and Spark broadcasts them or not by its own limit.
    """
    b = bounds.select(F.col("_lang").alias("_bl"), F.col("_source").alias("_bs"), *[c for c in bounds.columns if c[0] != "_"])
    within = F.lit(True)
    for m in MEASURES:
        value = F.expr(m.sql)
        within = within & (value <= F.col(f"hi_{m.name}"))
        if m.both:
            within = within & (value >= F.col(f"lo_{m.name}"))
    joined = measured.join(b, measured["_lang"].eqNullSafe(b["_bl"]) & measured["_source"].eqNullSafe(b["_bs"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True))).select(*measured.columns, "kept")


def judged(docs: DataFrame, **names) -> DataFrame:
    """Measures, sketches and judges documents. Texts are read once: the slim measures are stored."""
    measured = materialize(measure(docs, **names), "quality-measures")
    return judge(measured, materialize(thresholds(sketch(measured)), "quality-bounds"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns."""
    bad = judged(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, source_col=source_col).filter("not kept")
    bad = bad.select(*[F.col(c).alias(f"__bad{c}") for c in ("_id", "_h", "_lang", "_source")]).distinct()
    own = {"_id": F.col(id_col), "_h": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), "_lang": F.col(lang_col), "_source": F.col(source_col)}
    cond = F.lit(True)
    for c, v in own.items():
        cond = cond & v.eqNullSafe(F.col(f"__bad{c}"))
    return docs.join(bad.hint("shuffle_hash"), cond, "left_anti")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text", "lang", "source")
    return judged(docs).select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _value(m: Measure) -> str:
    return m.sql.replace(" div ", " // ")


def _bound_sql(m: Measure) -> str:
    hi = f"max(CASE WHEN measure = '{m.name}' THEN b + {REACH} * greatest(b - a, {m.spread}) END) AS hi_{m.name}"
    lo = f", max(CASE WHEN measure = '{m.name}' THEN a - {REACH} * greatest(b - a, {m.spread}) END) AS lo_{m.name}"
    return hi + (lo if m.both else "")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_QUARTILES = """SELECT {by} measure, max(total) AS total, min(CASE WHEN below * 100 >= total * 25 THEN f END) AS q25,
 min(CASE WHEN below * 100 >= total * 75 THEN f END) AS q75 FROM (
 SELECT *, sum(n) OVER (PARTITION BY {by} measure ORDER BY f) AS below, sum(n) OVER (PARTITION BY {by} measure) AS total
 FROM (SELECT {by} measure, f, sum(n) AS n FROM sk GROUP BY ALL)) GROUP BY {group} measure"""
SQL = f"""
WITH base AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
wins AS (SELECT doc_id, i, list_aggregate(ws[i:i + 7], 'string_agg', ' ') AS win FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM base)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS r FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM base),
c AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
 coalesce(r, 0) AS n_repeat_words, len(ls)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')))::BIGINT AS n_capitals,
 (length(t) - length(replace(t, '!', '')))::BIGINT AS n_shouts,
 len(list_filter(generate_series(2, len(ws)), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutters FROM base JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
vals AS ({" UNION ALL ".join(f"SELECT lang, source, '{m.name}' AS measure, {_value(m)} AS v FROM c" for m in MEASURES)}),
sk AS (SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS f, count(*) AS n FROM vals GROUP BY ALL),
own AS ({_QUARTILES.format(by="lang, source,", group="lang, source,")}),
lg AS ({_QUARTILES.format(by="lang,", group="lang,")}),
al AS ({_QUARTILES.format(by="", group="")}),
q AS (SELECT own.lang, own.source, own.measure,
 CASE WHEN own.total >= {MIN_GROUP} THEN own.q25 WHEN lg.total >= {MIN_GROUP} THEN lg.q25 ELSE al.q25 END AS a,
 CASE WHEN own.total >= {MIN_GROUP} THEN own.q75 WHEN lg.total >= {MIN_GROUP} THEN lg.q75 ELSE al.q75 END AS b
 FROM own JOIN lg ON own.lang IS NOT DISTINCT FROM lg.lang AND own.measure = lg.measure JOIN al ON own.measure = al.measure),
bo AS (SELECT lang, source, {", ".join(_bound_sql(m) for m in MEASURES)} FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
 NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {" AND ".join(f"{_value(m)} <= hi_{m.name}" + (f" AND {_value(m)} >= lo_{m.name}" if m.both else "") for m in MEASURES)} AS kept
FROM c JOIN bo ON c.lang IS NOT DISTINCT FROM bo.lang AND c.source IS NOT DISTINCT FROM bo.source
"""
QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES = {"op5_quality_rules": SQL}
