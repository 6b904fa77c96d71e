"""Registered queries: sources, preparation, splitting, batching, mixing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mixing as X
from ..operators import prepare as P
from ..plans.session import fresh_path, materialize
from ..sources import configs as SC
from ..sources import corpus as C
from ..sources import trials as ST
from ..sources.tables import table
from .kit import TOKENS_CTE, VOCAB_CTE, u_sql, words_sql

QUERIES, SQL = {}, {}


def _docs(spark, d, *more):
    return table(spark, d, "documents", "doc_id", "text", *more, many_tasks=True)


# -- sources ----------------------------------------------------------------------------


def a1_read_text(spark, d):
    path = fresh_path(spark, "text")
    _docs(spark, d).select("text").write.text(path)
    lines = C.read_text(spark, path)
    return lines.groupBy(F.md5("text").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


QUERIES["a1_read_text"] = a1_read_text
SQL["a1_read_text"] = (
    "SELECT md5(l) AS line_md5, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY 1"
)


def a2_read_labelled(spark, d):
    path = fresh_path(spark, "labelled")
    labels = table(spark, d, "labels", "doc_id", "quality")
    rows = _docs(spark, d).join(labels, "doc_id").select(F.col("text").alias("sentence"), F.col("quality").alias("label"))
    opts = dict(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows.write.csv(path, **opts)
    return C.read_labelled(spark, path, name="sst2", multi_line=True).select(F.md5("text").alias("text_md5"), "label")


QUERIES["a2_read_labelled"] = a2_read_labelled
SQL["a2_read_labelled"] = "SELECT md5(text) AS text_md5, quality AS label FROM documents JOIN labels USING (doc_id)"


def a3_resolve_splits(spark, d):
    m = F.col("doc_id") % 20
    name = F.when(m == 0, "valid").when(m == 1, "dev").when(m == 2, "test").when(m == 3, "spare").otherwise("train")
    return C.resolve_splits(table(spark, d, "documents", "doc_id").withColumn("split", name))


QUERIES["a3_resolve_splits"] = a3_resolve_splits
SQL["a3_resolve_splits"] = (
    "SELECT doc_id, CASE doc_id % 20 WHEN 0 THEN 'validation' WHEN 2 THEN 'test' ELSE 'train' END AS split "
    "FROM documents WHERE doc_id % 20 NOT IN (1, 3)"
)


def image_rows(spark, d):
    return C.pixel_rows(table(spark, d, "embeddings", "vec_id", "embedding", "label", many_tasks=True), "vec_id", "embedding", 8, 8)


def digest_pixels(df, *keep):
    """Pixels as two rounded sums, since float arrays are not compared."""
    x = lambda p: p.cast("double")
    plain = F.aggregate(F.transform("pixels", x), F.lit(0.0), lambda a, v: a + v)
    weighted = F.aggregate(F.transform("pixels", lambda p, i: x(p) * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return df.select(*keep, F.size("pixels").cast("bigint").alias("n"), F.round(plain, 4).alias("s"), F.round(weighted, 4).alias("ws"))


def digest_sql(a: str) -> str:
    return (
        f"len({a})::BIGINT AS n, round(list_sum(list_transform({a}, lambda x: x::DOUBLE)), 4) AS s, "
        f"round(list_sum(list_transform({a}, lambda x, i: x::DOUBLE * i)), 4) AS ws"
    )


def a4_read_images(spark, d):
    path = fresh_path(spark, "images")
    image_rows(spark, d).write.parquet(path)
    return digest_pixels(C.read_images(spark, path), "id", "channels", "height", "width", "label")


QUERIES["a4_read_images"] = a4_read_images
SQL["a4_read_images"] = f"SELECT vec_id AS id, 1 AS channels, 8 AS height, 8 AS width, label, {digest_sql('embedding')} FROM embeddings"


def run_logs(spark, d):
    """Events shaped as logs: one run per user and 512 consecutive event ids, which bounds the
    points of a run; one point per event."""
    e = table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    part = F.floor(F.col("event_id") / 512)
    point = F.create_map(F.lit("step"), F.col("event_id").cast("double"), F.col("event_type"), F.col("value"))
    return e.groupBy("user_id", part.alias("part")).agg(
        F.concat_ws("-", F.lit("run"), F.first("user_id").cast("string"), F.first(part).cast("string")).alias("name"),
        F.lit("{}").alias("config"),
        F.create_map(F.lit("trial"), F.first("user_id").cast("string")).alias("tags"),
        F.collect_list(point).alias("metrics"),
        F.collect_list(
            F.when(F.col("event_type") == "error", F.struct(F.concat(F.lit("out/"), F.col("event_id").cast("string")).alias("path"), F.lit("results").alias("type")))
        ).alias("artifacts"),
        (F.max("value") > 50).alias("accepted"),
    ).drop("user_id", "part")


def _stored_logs(spark, d):
    path = fresh_path(spark, "logs")
    run_logs(spark, d).write.json(path)
    return ST.read_run_logs(spark, path)


def a5_read_run_logs(spark, d):
    return ST.metric_rows(_stored_logs(spark, d))


QUERIES["a5_read_run_logs"] = a5_read_run_logs
_RUN = "'run-' || user_id || '-' || (event_id // 512)"
SQL["a5_read_run_logs"] = f"SELECT {_RUN} AS run, event_id AS step, event_type AS metric, value FROM events"


def a5_run_artifacts(spark, d):
    return ST.artifact_rows(_stored_logs(spark, d))


QUERIES["a5_run_artifacts"] = a5_run_artifacts
SQL["a5_run_artifacts"] = f"SELECT {_RUN} AS run, 'out/' || event_id AS path, 'results' AS type FROM events WHERE event_type = 'error'"


def a6_append_trials(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    decision = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "rejected")
    path = fresh_path(spark, "trials")
    rows = o.select(F.col("o_orderkey").alias("trial_id"), F.col("o_totalprice").alias("primary_metric"), decision.alias("decision"))
    ST.append_trials(rows.filter("trial_id % 2 = 0"), path)
    ST.append_trials(rows.filter("trial_id % 2 = 1").withColumn("reason", F.lit("second batch")), path)
    return ST.read_trials(spark, path).drop("timestamp")


QUERIES["a6_append_trials"] = a6_append_trials
SQL["a6_append_trials"] = """
SELECT o_orderkey AS trial_id, NULL::VARCHAR AS config_hash, '{}' AS augmentations_json, '{}' AS tuning_json, '{}' AS metrics_json,
 o_totalprice AS primary_metric, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'rejected' ELSE 'unknown' END AS decision,
 CASE WHEN o_orderkey % 2 = 1 THEN 'second batch' END AS reason, '[]' AS diff_json, NULL::VARCHAR AS branch_name, NULL::VARCHAR AS pr_url FROM orders
"""


def a7_extract_html(spark, d):
    pages = table(spark, d, "pages", "page_id", "html", many_tasks=True)
    return C.extract_payloads(pages, "page_id", "html", "html").select("page_id", F.md5("text").alias("text_md5"))


QUERIES["a7_extract_html"] = a7_extract_html
SQL["a7_extract_html"] = r"""
WITH p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1),
  lambda p: trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(p, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'),
   '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), ' ')), lambda p: p <> '') AS ps FROM pages),
t AS (SELECT page_id, array_to_string(ps, chr(10)) AS text FROM p)
SELECT page_id, md5(text) AS text_md5 FROM t WHERE length(text) > 50
"""


def a7_extract_feed(spark, d):
    """Documents wrapped as a feed of two entries, the second without a summary."""
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    feed = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><summary> \n'), esc, F.lit(" \n</summary></entry><entry><id>2</id></entry></feed>")
    )
    rows = _docs(spark, d).select("doc_id", feed.alias("payload"))
    return C.extract_payloads(rows, "doc_id", "payload", "arxiv").select("doc_id", F.md5("text").alias("text_md5"))


QUERIES["a7_extract_feed"] = a7_extract_feed
SQL["a7_extract_feed"] = r"SELECT doc_id, md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS text_md5 FROM documents"


def a7_extract_json(spark, d):
    """Responses with a too short page before the page proper."""
    body = F.to_json(
        F.struct(
            F.struct(
                F.create_map(
                    F.lit("1"), F.struct(F.lit("short").alias("extract")), F.lit("2"), F.struct(F.col("text").alias("extract"))
                ).alias("pages")
            ).alias("query")
        )
    )
    rows = _docs(spark, d).select("doc_id", body.alias("payload"))
    return C.extract_payloads(rows, "doc_id", "payload", "wikipedia").select("doc_id", F.md5("text").alias("text_md5"))


QUERIES["a7_extract_json"] = a7_extract_json
SQL["a7_extract_json"] = "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE length(text) > 50"


def a8_write_results(spark, d):
    """Training results per trial; here every user is a trial and every event an evaluation."""
    e = table(spark, d, "events", "event_id", "user_id", "value", "ts")
    rows = e.groupBy(F.col("user_id").alias("trial_id")).agg(
        F.avg("value").alias("train_loss"),
        F.create_map(F.lit("loss"), F.min("value"), F.lit("last"), F.max_by("value", "event_id")).alias("eval_metrics"),
        F.count(F.lit(1)).alias("steps_completed"),
        # as many entries as a trial has evaluations
        F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("step"), F.col("value").alias("loss")))).alias("eval_history"),
        (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("elapsed_us"),
    )
    path = fresh_path(spark, "results")
    ST.write_results(rows, path)
    back = spark.read.parquet(path)
    return back.select(
        "trial_id", F.round("train_loss", 6).alias("train_loss"), F.col("eval_metrics")["loss"].alias("loss"),
        F.col("eval_metrics")["last"].alias("last"), "steps_completed", "elapsed_us",
        F.array_join(F.transform("eval_history", lambda h: h["step"].cast("string")), ",").alias("history_steps"),
        F.element_at("eval_history", -1)["loss"].alias("history_last"),
    )


QUERIES["a8_write_results"] = a8_write_results
SQL["a8_write_results"] = (
    "SELECT user_id AS trial_id, round(avg(value), 6) AS train_loss, min(value) AS loss, max_by(value, event_id) AS last, "
    "count(*)::BIGINT AS steps_completed, epoch_us(max(ts)) - epoch_us(min(ts)) AS elapsed_us, "
    "string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS history_steps, max_by(value, event_id) AS history_last FROM events GROUP BY user_id"
)


def a9_read_configs(spark, d):
    """Configs written as JSON, one per event; every 13th is no object."""
    e = table(spark, d, "events", "event_id", "value", "event_type")
    text = F.when(F.col("event_id") % 13 == 0, '["just", "a list"]').otherwise(
        F.concat(
            F.lit('{"optimizer": {"name": "'), F.col("event_type"), F.lit('", "learning_rate": '), F.col("value").cast("string"), F.lit('}, "seed": '),
            F.col("event_id").cast("string"), F.lit("}"),
        )
    )
    rows = SC.read_configs(e.select(F.col("event_id").alias("config_id"), text.alias("config")))
    return rows.select(
        "config_id", F.get_json_object("config", "$.optimizer.name").alias("name"),
        F.get_json_object("config", "$.optimizer.learning_rate").cast("double").alias("learning_rate"),
        F.get_json_object("config", "$.seed").cast("bigint").alias("seed"),
    )


QUERIES["a9_read_configs"] = a9_read_configs
SQL["a9_read_configs"] = (
    "SELECT event_id AS config_id, event_type AS name, value AS learning_rate, event_id AS seed FROM events WHERE event_id % 13 <> 0"
)

# -- preparation ------------------------------------------------------------------------


def b1_tokenize(spark, d):
    t = P.tokenize(_docs(spark, d), lower=True)
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n"), F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


QUERIES["b1_tokenize"] = b1_tokenize
SQL["b1_tokenize"] = (
    f"SELECT doc_id, len(ws)::BIGINT AS n, md5(array_to_string(ws, '|')) AS tokens_md5 FROM (SELECT doc_id, {words_sql('lower(text)')} AS ws FROM documents)"
)


def vocab_500(spark, d):
    return P.build_vocab(P.tokenize(_docs(spark, d), lower=True), max_size=500, min_count=2)


def b2_build_vocab(spark, d):
    return P.build_vocab(P.tokenize(_docs(spark, d), lower=True), max_size=None, min_count=2)


QUERIES["b2_build_vocab"] = b2_build_vocab
SQL["b2_build_vocab"] = f"WITH {VOCAB_CTE} SELECT tok, cnt, (rank + 2)::INT AS id FROM vocab WHERE cnt >= 2"


def encoded(spark, d):
    return P.encode(P.tokenize(_docs(spark, d), lower=True), materialize(vocab_500(spark, d), "vocab"))


ENC_CTE = f"""{VOCAB_CTE}, ids AS (SELECT tok, rank + 2 AS id FROM vocab WHERE cnt >= 2 AND rank < 500),
w AS (SELECT doc_id, unnest(ws) AS tok, generate_subscripts(ws, 1) AS pos FROM (SELECT doc_id, {words_sql('lower(text)')} AS ws FROM documents)),
full_ AS (SELECT doc_id, list(coalesce(id, 1)::INT ORDER BY pos) AS input_ids FROM w LEFT JOIN ids ON ids.tok = w.tok GROUP BY doc_id),
enc AS (SELECT doc_id, coalesce(input_ids, []) AS input_ids FROM documents LEFT JOIN full_ USING (doc_id))"""


def _ids(df, *cols):
    return [F.md5(F.array_join(c, ",")).alias(f"{c}_md5") for c in cols]


def b2_encode(spark, d):
    return encoded(spark, d).select("doc_id", *_ids(None, "input_ids"))


def b2_encode_whole_vocab(spark, d):
    """Every seventh text is blank; no limit on the vocabulary."""
    docs = _docs(spark, d).withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.lit(" ")).otherwise(F.col("text")))
    tokens = P.tokenize(docs, lower=True)
    return P.encode(tokens, materialize(P.build_vocab(tokens), "vocab")).select("doc_id", *_ids(None, "input_ids"))


QUERIES["b2_encode"] = b2_encode
QUERIES["b2_encode_whole_vocab"] = b2_encode_whole_vocab
SQL["b2_encode_whole_vocab"] = f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN [] ELSE {words_sql('lower(text)')} END AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS tok, generate_subscripts(ws, 1) AS pos FROM d),
v AS (SELECT tok, row_number() OVER (ORDER BY count(*) DESC, tok) + 1 AS id FROM w GROUP BY tok),
e AS (SELECT doc_id, string_agg(id::VARCHAR, ',' ORDER BY pos) AS ids FROM w JOIN v USING (tok) GROUP BY doc_id)
SELECT doc_id, md5(coalesce(ids, '')) AS input_ids_md5 FROM d LEFT JOIN e USING (doc_id)"""
SQL["b2_encode"] = f"WITH {ENC_CTE} SELECT doc_id, md5(array_to_string(input_ids, ',')) AS input_ids_md5 FROM enc"


def b3_truncate_pad(spark, d):
    return P.truncate_pad(encoded(spark, d), 128).select("doc_id", *_ids(None, "input_ids", "attention_mask", "special_tokens_mask"))


QUERIES["b3_truncate_pad"] = b3_truncate_pad
SQL["b3_truncate_pad"] = f"""WITH {ENC_CTE},
p AS (SELECT doc_id, list_transform(range(1, 129), lambda i: coalesce(input_ids[i], 0)) AS ids,
  list_transform(range(1, 129), lambda i: CASE WHEN i <= len(input_ids) THEN 1 ELSE 0 END) AS mask FROM enc)
SELECT doc_id, md5(array_to_string(ids, ',')) AS input_ids_md5, md5(array_to_string(mask, ',')) AS attention_mask_md5,
 md5(array_to_string(list_transform(ids, lambda x: CASE WHEN x <= 1 THEN 1 ELSE 0 END), ',')) AS special_tokens_mask_md5 FROM p"""

BLOCKS_CTE = f"""{TOKENS_CTE}, flat AS (SELECT doc_id, unnest(ws) AS tok, generate_subscripts(ws, 1) AS pos FROM toks),
o AS (SELECT tok, row_number() OVER (ORDER BY doc_id, pos) - 1 AS off FROM flat),
blocks AS (SELECT off // 512 AS block_id, list(tok ORDER BY off) AS input_ids FROM o GROUP BY 1 HAVING count(*) = 512)"""


def packed(spark, d):
    return P.pack_sequences(P.tokenize(_docs(spark, d)), 512, ids="tokens")


def b4_pack_sequences(spark, d):
    return packed(spark, d).select("block_id", F.md5(F.array_join("input_ids", " ")).alias("block_md5"))


QUERIES["b4_pack_sequences"] = b4_pack_sequences
SQL["b4_pack_sequences"] = f"WITH {BLOCKS_CTE} SELECT block_id, md5(array_to_string(input_ids, ' ')) AS block_md5 FROM blocks"


def b4_pack_padded(spark, d):
    """Rows padded to the block length before packing: every row is one block."""
    return P.pack_sequences(materialize(encoded(spark, d), "encoded"), 128, prepad=True).select("block_id", *_ids(None, "input_ids"))


QUERIES["b4_pack_padded"] = b4_pack_padded
SQL["b4_pack_padded"] = f"""WITH {ENC_CTE},
p AS (SELECT doc_id, list_transform(range(1, 129), lambda i: coalesce(input_ids[i], 0)) AS ids FROM enc)
SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS block_id, md5(array_to_string(ids, ',')) AS input_ids_md5 FROM p"""


def b5_lm_labels(spark, d):
    out = P.lm_labels(P.truncate_pad(encoded(spark, d), 128), mask_pads=True)
    return out.select("doc_id", *_ids(None, "labels"))


QUERIES["b5_lm_labels"] = b5_lm_labels
SQL["b5_lm_labels"] = f"""WITH {ENC_CTE}
SELECT doc_id, md5(array_to_string(list_transform(range(1, 129), lambda i: coalesce(input_ids[i], -100)), ',')) AS labels_md5 FROM enc"""


def b6_exact_split(spark, d):
    return P.exact_split(table(spark, d, "embeddings", "vec_id", "label"), "vec_id")


QUERIES["b6_exact_split"] = b6_exact_split
SQL["b6_exact_split"] = f"""SELECT vec_id, label, CASE WHEN row_number() OVER (ORDER BY {u_sql(42, 'split', 'vec_id', 0)}, vec_id)
 <= floor(0.9::DOUBLE * (SELECT count(*) FROM embeddings)) THEN 'train' ELSE 'validation' END AS split FROM embeddings"""


def b6_approx_split(spark, d):
    return P.exact_split(table(spark, d, "documents", "doc_id"), "doc_id", approx=True)


QUERIES["b6_approx_split"] = b6_approx_split
SQL["b6_approx_split"] = (
    f"SELECT doc_id, CASE WHEN {u_sql(42, 'split', 'doc_id', 0)} < 0.9::DOUBLE THEN 'train' ELSE 'validation' END AS split FROM documents"
)


def b7_assign_batches(spark, d):
    ids = table(spark, d, "documents", "doc_id")
    train = P.assign_batches(ids, "doc_id", 7).withColumn("kind", F.lit("train"))
    return train.unionByName(P.assign_batches(ids, "doc_id", 16, shuffle=False, drop_last=False).withColumn("kind", F.lit("eval")))


QUERIES["b7_assign_batches"] = b7_assign_batches
SQL["b7_assign_batches"] = f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {u_sql(42, 'batch', 'doc_id', 0)}, doc_id) - 1 AS a, row_number() OVER (ORDER BY doc_id) - 1 AS b,
  count(*) OVER () AS n FROM documents)
SELECT doc_id, (a // 7)::BIGINT AS batch_id, 'train' AS kind FROM r WHERE a < n - n % 7
UNION ALL SELECT doc_id, (b // 16)::BIGINT, 'eval' FROM r"""


def b8_standardize_channels(spark, d):
    small = P.resize(image_rows(spark, d), 4, 8, 8)
    big = P.resize(image_rows(spark, d), 12, 8, 8, method="bilinear")
    out = P.standardize_channels(small, 16, scale=255.0).withColumn("size", F.lit(4))
    return digest_pixels(out.unionByName(P.standardize_channels(big, 144, scale=255.0).withColumn("size", F.lit(12))), "id", "size")


QUERIES["b8_standardize_channels"] = b8_standardize_channels
_std = "list_transform({a}, lambda x: (x::DOUBLE / 255.0::DOUBLE - 0.4914::DOUBLE) / 0.2470::DOUBLE)"
_fy, _fx = (f"greatest(0.0::DOUBLE, ({v} + 0.5::DOUBLE) * (8.0::DOUBLE / 12.0::DOUBLE) - 0.5::DOUBLE)" for v in ("(i // 12)", "(i % 12)"))
_y0, _x0 = f"floor({_fy})::BIGINT", f"floor({_fx})::BIGINT"
_y1, _x1 = f"least({_y0} + 1, 7)", f"least({_x0} + 1, 7)"
_at = lambda y, x: f"embedding[{y} * 8 + {x} + 1]::DOUBLE"
_dx, _dy = f"({_fx} - floor({_fx}))", f"({_fy} - floor({_fy}))"
_bil = (
    f"list_transform(range(0, 144), lambda i: ({_at(_y0, _x0)} * (1 - {_dx}) + {_at(_y0, _x1)} * {_dx}) * (1 - {_dy})"
    f" + ({_at(_y1, _x0)} * (1 - {_dx}) + {_at(_y1, _x1)} * {_dx}) * {_dy})"
)
_near = "list_transform(range(0, 16), lambda i: embedding[(i // 4) * 2 * 8 + (i % 4) * 2 + 1])"
SQL["b8_standardize_channels"] = f"""
WITH p AS (SELECT vec_id AS id, 4 AS size, {_std.format(a=_near)} AS px FROM embeddings
 UNION ALL SELECT vec_id, 12, {_std.format(a=_bil)} FROM embeddings)
SELECT id, size, {digest_sql('px')} FROM p"""


def b9_task_router(spark, d):
    """The three preparations behind one call, as row counts and lengths."""
    docs = _docs(spark, d).join(table(spark, d, "labels", "doc_id", "quality"), "doc_id")
    lm = P.prepare("language_modeling", _docs(spark, d), max_length=64, vocab_size=500)
    tc = P.prepare("text_classification", docs, max_length=64, vocab_size=500, label="quality")
    im = P.prepare("image_classification", image_rows(spark, d), height=8, width=8, channels=1, image_size=4)
    one = lambda df, task, c: df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size(c)).cast("bigint").alias("elements")
    ).withColumn("task", F.lit(task))
    return one(lm, "language_modeling", "labels").unionByName(one(tc, "text_classification", "input_ids")).unionByName(
        one(im, "image_classification", "pixels")
    )


QUERIES["b9_task_router"] = b9_task_router
SQL["b9_task_router"] = f"""
WITH t AS (SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
b AS (SELECT sum(len({words_sql('text')}))::BIGINT // 64 AS k FROM documents)
SELECT 'language_modeling' AS task, k::BIGINT AS rows, (k * 64)::BIGINT AS elements FROM b
UNION ALL SELECT 'text_classification', count(*)::BIGINT, (count(*) * 64)::BIGINT FROM t
UNION ALL SELECT 'image_classification', count(*)::BIGINT, (count(*) * 16)::BIGINT FROM embeddings"""

# -- mixing -----------------------------------------------------------------------------


def _external(spark, d):
    pages = table(spark, d, "pages", "page_id", "html", many_tasks=True)
    return C.extract_payloads(pages, "page_id", "html", "html").withColumnRenamed("page_id", "id")


PAGES_CTE = "ext AS (" + r"""WITH p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1),
  lambda p: trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(p, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'),
   '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), ' ')), lambda p: p <> '') AS ps FROM pages)
 SELECT page_id AS id, array_to_string(ps, chr(10)) AS text FROM p WHERE length(array_to_string(ps, chr(10))) > 50)"""


def e1_fetch_union(spark, d):
    docs = _docs(spark, d, "source").withColumnRenamed("doc_id", "id")
    have = {"wikipedia": _external(spark, d), "src3": docs.filter("source = 'src3'"), "src5": docs.filter("source = 'src5'")}
    out = X.fetch_union(have, ["src3", "nowhere", "wikipedia", "src5"], max_results=20)
    return out.select("source", "id", F.md5("text").alias("text_md5"))


QUERIES["e1_fetch_union"] = e1_fetch_union
SQL["e1_fetch_union"] = f"""
WITH {PAGES_CTE}, u AS (SELECT 0 AS pos, 'src3' AS source, doc_id AS id, text FROM documents WHERE source = 'src3'
 UNION ALL SELECT 2, 'wikipedia', id, text FROM ext UNION ALL SELECT 3, 'src5', doc_id, text FROM documents WHERE source = 'src5'),
c AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY source ORDER BY id) <= 20)
SELECT source, id, md5(text) AS text_md5 FROM c ORDER BY pos, id LIMIT 20"""


def e2_mix_external(spark, d):
    base = _docs(spark, d).withColumnRenamed("doc_id", "id")
    out = X.mix_external(base, [_external(spark, d)], 0.1)
    return out.select("id", "origin", F.md5("text").alias("text_md5"), "pii_count")


QUERIES["e2_mix_external"] = e2_mix_external


def _mix_sql() -> str:
    from .safety import findings_sql

    draw = u_sql(42, "mix", "'external0:' || id", 0)
    return f"""
WITH {PAGES_CTE}, k AS (SELECT id AS doc_id, text FROM ext QUALIFY row_number() OVER (ORDER BY {draw}, id) <= (SELECT floor(0.1::DOUBLE * count(*)) FROM documents)),
f AS (SELECT doc_id, count(*) AS n FROM {findings_sql('k')} GROUP BY doc_id)
SELECT doc_id AS id, 'base' AS origin, md5(text) AS text_md5, NULL::BIGINT AS pii_count FROM documents
UNION ALL SELECT k.doc_id, 'external0', md5(k.text), coalesce(f.n, 0)::BIGINT FROM k LEFT JOIN f ON f.doc_id = k.doc_id"""


SQL["e2_mix_external"] = _mix_sql()
