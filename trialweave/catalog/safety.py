"""Registered queries: personal-data and license screening over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import safety as S
from ..operators.text_augment import TextAugmenter
from ..sources.tables import table
from .kit import sql_str, u_sql, words_sql
from .text import AUGMENTED_SQL, COLUMN_CONFIG

QUERIES, SQL = {}, {}


def _docs(spark, d, *more):
    return table(spark, d, "documents", "doc_id", "text", *more, many_tasks=True)


def _rule_sql(src: str, kind: str, pattern: str, score) -> str:
    p = sql_str(pattern)
    if kind == "CREDIT_CARD":
        dig = "substr(m, i, 1)::INT"
        twice = f"CASE WHEN {dig} > 4 THEN {dig} * 2 - 9 ELSE {dig} * 2 END"
        luhn = f"list_sum(list_transform(range(1, length(m) + 1), lambda i: CASE WHEN (length(m) - i) % 2 = 1 THEN {twice} ELSE {dig} END))"
        s = f"CASE WHEN {luhn} % 10 = 0 THEN 1.0 ELSE 0.3 END"
    elif kind == "IBAN_CODE":
        moved = "(substr(m, 5) || substr(m, 1, 4))"
        digits = (
            f"list_aggregate(list_transform(range(1, length(m) + 1), lambda i: CASE WHEN ascii(substr({moved}, i, 1)) < 65 "
            f"THEN substr({moved}, i, 1) ELSE (ascii(substr({moved}, i, 1)) - 55)::VARCHAR END), 'string_agg', '')"
        )
        s = f"CASE WHEN list_reduce(list_transform(string_split({digits}, ''), lambda c: c::INT), lambda a, b: (a * 10 + b) % 97) = 1 THEN 1.0 ELSE 0.3 END"
    elif score is None:
        near = " OR ".join(f"contains(lower(before), '{w}')" for w in S.CONTEXT_WORDS[kind])
        s = f"CASE WHEN {near} THEN 0.8 ELSE 0.3 END"
    else:
        s = str(score)
    return f"""SELECT doc_id, '{kind}' AS type, ({s})::DOUBLE AS score, start, start + length(m) AS "end", m AS text FROM
  (SELECT *, substr(text, greatest(1, start - 49), least(50, start)) AS before FROM
    (SELECT doc_id, text, ms[i] AS m, (list_sum(list_transform(gs[1:i], lambda x: length(x)))
       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start FROM
      (SELECT doc_id, text, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM
        (SELECT doc_id, text, regexp_extract_all(text, {p}) AS ms, regexp_split_to_array(text, {p}) AS gs FROM {src}
         WHERE regexp_matches(text, {p})))))"""


def findings_sql(src: str, threshold: float = S.DEFAULT_THRESHOLD) -> str:
    union = "\nUNION ALL ".join(_rule_sql(src, *r) for r in S.PII_RULES)
    return f"(SELECT * FROM ({union}) WHERE score >= {threshold}::DOUBLE)"


PII_COLUMNS = ["doc_id", "type", "score", "start", "end", "text"]


def f1_pii_scan(spark, d):
    return S.pii_scan(_docs(spark, d)).select(*PII_COLUMNS)


QUERIES["f1_pii_scan"] = f1_pii_scan
SQL["f1_pii_scan"] = f'SELECT doc_id, type, score, start, "end", text FROM {findings_sql("documents")}'


def f1_pii_scan_all_scores(spark, d):
    """Every candidate, also those whose check digits or context are missing."""
    return S.pii_scan(_docs(spark, d), threshold=0.0).select(*PII_COLUMNS)


QUERIES["f1_pii_scan_all_scores"] = f1_pii_scan_all_scores
SQL["f1_pii_scan_all_scores"] = f'SELECT doc_id, type, score, start, "end", text FROM {findings_sql("documents", 0.0)}'


def name_list(spark, d):
    """Names for the person rule: the two words each benchmark item begins with."""
    return table(spark, d, "benchmark", "text").select(F.split("text", " ").alias("w")).select(
        F.col("w")[0].alias("given"), F.col("w")[1].alias("family")
    )


def f1_person_scan(spark, d):
    return S.person_scan(_docs(spark, d), name_list(spark, d)).select(*PII_COLUMNS)


QUERIES["f1_person_scan"] = f1_person_scan
_len = "list_transform({}, lambda x: length(x))"
SQL["f1_person_scan"] = f"""
WITH names AS (SELECT DISTINCT string_split(text, ' ')[1] AS given, string_split(text, ' ')[2] AS family FROM benchmark),
t AS (SELECT doc_id, text, {words_sql('text')} AS ws FROM documents),
p AS (SELECT doc_id, text, ws, unnest(range(1, len(ws))) AS i FROM t),
h AS (SELECT p.* FROM p JOIN names n ON n.given = ws[i] AND n.family = ws[i + 1]),
b AS (SELECT *, regexp_extract_all(text, {sql_str(S.BLANKS)}) AS bs, CASE WHEN regexp_matches(text, {sql_str('^' + S.BLANKS)}) THEN 1 ELSE 0 END AS ld FROM h),
s AS (SELECT *, (coalesce(list_sum({_len.format('ws[1:i - 1]')}), 0) + coalesce(list_sum({_len.format('bs[1:i - 1 + ld]')}), 0))::BIGINT AS start,
  length(ws[i]) + length(bs[i + ld]) + length(ws[i + 1]) AS span FROM b)
SELECT doc_id, 'PERSON' AS type, 0.75::DOUBLE AS score, start, start + span AS "end", substr(text, start + 1, span) AS text FROM s
"""


def f2_pii_report(spark, d):
    docs = _docs(spark, d)
    r = S.pii_report(docs, S.pii_scan(docs))
    return r.select(
        "safe", "total_scanned", "pii_count",
        F.array_join(F.transform("pii_found", lambda f: F.concat_ws("|", f["doc_id"].cast("string"), f["start"].cast("string"), f["type"])), ";").alias("found"),
        F.array_join("issues", "\n").alias("issues"),
    )


QUERIES["f2_pii_report"] = f2_pii_report
SQL["f2_pii_report"] = f"""
WITH f AS (SELECT *, row_number() OVER (ORDER BY doc_id, start, type) AS rn FROM {findings_sql("documents")})
SELECT count(*) = 0 AS safe, (SELECT count(*) FROM documents)::BIGINT AS total_scanned, count(*)::BIGINT AS pii_count,
 coalesce(string_agg(concat_ws('|', doc_id, start, type), ';' ORDER BY rn) FILTER (rn <= 10), '') AS found,
 coalesce(string_agg('Found ' || type || ' (score=' || printf('%.2f', score) || '): ''' || text || '''', chr(10) ORDER BY rn) FILTER (rn <= 5), '') AS issues
FROM f
"""


def f3_sample_for_scan(spark, d):
    return S.sample_for_scan(_docs(spark, d).select("doc_id"), sample_size=100)


QUERIES["f3_sample_for_scan"] = f3_sample_for_scan
SQL["f3_sample_for_scan"] = f"SELECT doc_id FROM documents ORDER BY {u_sql(42, 'scan_sample', 'doc_id', 0)}, doc_id LIMIT 100"


def mixing_configs(spark, d):
    """Configs as JSON rows, one per event: mixing on and off, with and without sources."""
    e = table(spark, d, "events", "event_id", "props").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    sources = F.when(F.col("k") % 3 == 0, "[]").when(F.col("k") % 3 == 1, '["arxiv"]').otherwise('["arxiv","wikipedia"]')
    mixing = F.concat(
        F.lit(',"data_mixing":{"enabled":'), (F.col("k") % 2 == 0).cast("string"), F.lit(',"sources":'), sources, F.lit("}")
    )
    mixing = F.when(F.col("k") % 5 == 0, "").otherwise(mixing)
    return e.select(
        F.col("event_id").alias("config_id"), F.concat(F.lit('{"pipeline":{"enabled":true'), mixing, F.lit("}}")).alias("config")
    )


def f4_mixing_risk(spark, d):
    return S.mixing_risk(mixing_configs(spark, d)).select("config_id", "safe", "issue")


QUERIES["f4_mixing_risk"] = f4_mixing_risk
RISK_SQL = "(k % 5 <> 0 AND k % 2 = 0 AND k % 3 <> 0)"
EVENTS_K = "(SELECT event_id AS config_id, user_id, event_type, (props ->> '$.k')::INT AS k FROM events)"
SQL["f4_mixing_risk"] = (
    f"SELECT config_id, NOT {RISK_SQL} AS safe, CASE WHEN {RISK_SQL} THEN {sql_str(S.MIXING_ISSUE)} END AS issue FROM {EVENTS_K}"
)

_policy = ", ".join(sql_str(n) for n in S.PERMISSIVE_LICENSES + S.RESEARCH_ONLY_LICENSES)
_names = "regexp_replace(lower(unnest(regexp_extract_all(text, {}, 1))), '\\.$', '')"
MENTIONS_SQL = " UNION ".join(
    [f"SELECT doc_id, source, '{i}' AS license FROM documents WHERE regexp_matches(text, {sql_str(p)})" for i, p in S.LICENSE_STATEMENTS]
    + [f"SELECT * FROM (SELECT doc_id, source, {_names.format(sql_str(S.NAMED_LICENSE))} AS license FROM documents) WHERE license IN ({_policy})"]
    + [f"SELECT doc_id, source, {_names.format(sql_str(S.LICENSE_TAG))} AS license FROM documents"]
)


def f6_license_mentions(spark, d):
    return S.license_mentions(_docs(spark, d))


QUERIES["f6_license_mentions"] = f6_license_mentions
SQL["f6_license_mentions"] = f"SELECT doc_id, license FROM ({MENTIONS_SQL})"


def class_sql(c: str) -> str:
    q = lambda names: ", ".join(f"'{n}'" for n in names)
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN lower(trim({c})) IN ({q(S.PERMISSIVE_LICENSES)}) THEN 'permissive' "
        f"WHEN lower(trim({c})) IN ({q(S.RESEARCH_ONLY_LICENSES)}) THEN 'research_only' ELSE 'other' END"
    )


def f5_classify_license(spark, d):
    m = S.license_mentions(_docs(spark, d))
    return m.select(
        "doc_id", "license", S.license_class(F.upper(F.concat(F.lit(" "), "license"))).alias("license_class"),
        S.license_compatible(F.col("license")).alias("compatible"),
    )


QUERIES["f5_classify_license"] = f5_classify_license
SQL["f5_classify_license"] = (
    f"SELECT doc_id, license, {class_sql('license')} AS license_class, {class_sql('license')} <> 'other' AS compatible FROM ({MENTIONS_SQL})"
)


def f5_license_violations(spark, d):
    return S.license_violations(S.license_mentions(_docs(spark, d)))


QUERIES["f5_license_violations"] = f5_license_violations
SQL["f5_license_violations"] = f"SELECT doc_id, license FROM ({MENTIONS_SQL}) WHERE {class_sql('license')} = 'other'"


def f7_license_report(spark, d):
    docs = _docs(spark, d, "source")
    r = S.license_report(S.license_mentions(docs, keep=("source",)), "source", docs)
    return r.select("source", "passed", F.array_join("licenses", ",").alias("licenses"), F.array_join("issues", "\n").alias("issues"))


QUERIES["f7_license_report"] = f7_license_report
SQL["f7_license_report"] = f"""
SELECT source, coalesce(bool_and({class_sql('license')} <> 'other'), true) AS passed, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses,
 coalesce(string_agg('Dataset ''' || source || ''' has license ''' || license || ''' which may restrict augmentation/modification.', chr(10) ORDER BY license)
   FILTER ({class_sql('license')} = 'other'), '') AS issues
FROM (SELECT source, license FROM ({MENTIONS_SQL}) UNION SELECT source, NULL FROM documents) GROUP BY source
"""


def _license_checks(spark, d):
    m = S.license_mentions(_docs(spark, d, "source"), keep=("source",))
    licenses = m.groupBy(F.col("source").alias("name")).agg(F.min("license").alias("license"))
    e = table(spark, d, "events", "event_id", "user_id", "event_type", "props").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    configs = e.select(
        F.col("event_id").alias("config_id"),
        F.concat(F.lit("src"), (F.col("k") % 20).cast("string")).alias("model"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("dataset"),
        (F.col("event_type") == "error").alias("web_fetcher"),
    )
    return S.check_licenses(configs, licenses)


CHECKS_SQL = f"""
WITH lic AS (SELECT source AS name, min(license) AS license FROM ({MENTIONS_SQL}) GROUP BY source),
c AS (SELECT config_id, k, 'src' || (k % 20) AS model, 'src' || (user_id % 20) AS dataset, event_type = 'error' AS web_fetcher FROM {EVENTS_K}),
j AS (SELECT c.*, a.license AS model_license, b.license AS dataset_license FROM c LEFT JOIN lic a ON a.name = c.model LEFT JOIN lic b ON b.name = c.dataset),
i AS (SELECT *, concat_ws(chr(10),
  CASE WHEN {class_sql('model_license')} = 'other' THEN 'Model ''' || model || ''' has license ''' || model_license || ''' which may restrict fine-tuning.' END,
  CASE WHEN {class_sql('dataset_license')} = 'other' THEN 'Dataset ''' || dataset || ''' has license ''' || dataset_license || ''' which may restrict augmentation/modification.' END,
  CASE WHEN web_fetcher THEN {sql_str(S.WEB_ISSUE)} END) AS issues FROM j)
"""


def f7_check_licenses(spark, d):
    return _license_checks(spark, d).select(
        "config_id", "passed", "model_license", "dataset_license", F.array_join("issues", "\n").alias("issues")
    )


QUERIES["f7_check_licenses"] = f7_check_licenses
SQL["f7_check_licenses"] = CHECKS_SQL + "SELECT config_id, issues = '' AS passed, model_license, dataset_license, issues FROM i"


def f8_safety_gate(spark, d):
    return S.safety_gate(S.mixing_risk(mixing_configs(spark, d)), _license_checks(spark, d))


QUERIES["f8_safety_gate"] = f8_safety_gate
SQL["f8_safety_gate"] = CHECKS_SQL + f"SELECT config_id, issues = '' AND NOT {RISK_SQL} AS safe FROM i"


def augment_and_scan(spark, d):
    """Flagship: augment every document, scan the result, report per source."""
    docs = _docs(spark, d, "source").withColumn("_before", F.md5("text"))
    rows = TextAugmenter(COLUMN_CONFIG).apply(docs).select(
        "source",
        (F.md5("text") != F.col("_before")).cast("bigint").alias("changed"),
        F.size(S.pii_findings(F.col("text"))).cast("bigint").alias("pii"),
    )
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("changed").alias("changed_documents"), F.sum("pii").alias("pii_count")
    )


QUERIES["augment_and_scan"] = augment_and_scan
SQL["augment_and_scan"] = f"""
WITH a AS (SELECT d.doc_id, d.source, n.text, n.text <> d.text AS changed FROM documents d JOIN {AUGMENTED_SQL} n ON n.doc_id = d.doc_id),
f AS (SELECT doc_id, count(*) AS pii FROM {findings_sql('a')} GROUP BY doc_id)
SELECT source, count(*)::BIGINT AS documents, sum(changed::INT)::BIGINT AS changed_documents, coalesce(sum(pii), 0)::BIGINT AS pii_count
FROM a LEFT JOIN f ON f.doc_id = a.doc_id GROUP BY source
"""
