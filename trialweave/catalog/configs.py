"""Registered queries: configs as data, one config per event, response or customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import configs as I
from ..sources.tables import table
from .kit import sql_str, u_sql

QUERIES, SQL = {}, {}


def _events(spark, d):
    e = table(spark, d, "events", "event_id", "user_id", "event_type", "value", "props", many_tasks=True)
    return e.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumnRenamed("event_id", "config_id")


EV = "ev AS (SELECT event_id AS config_id, user_id, event_type, value, (props ->> '$.k')::INT AS k FROM events)"


def _fill(template: str) -> list:
    """A JSON template with <column> marks as concat arguments."""
    out = []
    for i, part in enumerate(template.replace(">", "<").split("<")):
        out.append(F.col(part).cast("string") if i % 2 else F.lit(part))
    return out


def _fill_sql(template: str) -> str:
    parts = template.replace(">", "<").split("<")
    return "concat(" + ", ".join(p if i % 2 else sql_str(p) for i, p in enumerate(parts)) + ")"


BASE = (
    '{"optimizer":{"name":"<event_type>","learning_rate":<value>,"betas":[0.9,0.999],"eps":null},'
    '"scheduler":{"warmup_steps":<k>,"extra":{}},"batch":{"train_batch_size":8,"shuffle":true},"seed":<user_id>}'
)
PATCH_A = '{"optimizer":{"learning_rate":0.5,"nested":{"a":{"b":<k>}}},"seed":{"value":<k>}}'
PATCH_B = '{"scheduler":"none","optimizer":{"nested":<user_id>},"batch":{"train_batch_size":16},"tags":["x","<event_type>"]}'


def _config(df, template, name="config"):
    return df.withColumn(name, F.concat(*_fill(template)))


def _typed(leaves):
    """Numbers are compared as numbers, all else as text."""
    number = F.col("type").isin("integer", "number")
    return leaves.select("config_id", "path", "type", F.when(~number, F.col("value")).alias("value"), "num")


def leaves_sql(src: str, col: str) -> str:
    """(config_id, path, type, value, num) of the leaves of a JSON column."""
    return f"""(SELECT config_id, substr(fullkey, 3) AS path,
  CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object'
    WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END AS type,
  CASE WHEN type NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN j.value::VARCHAR END AS value,
  CASE WHEN type IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN j.value::DOUBLE END AS num
 FROM {src}, json_tree({col}::JSON) j WHERE fullkey <> '$' AND NOT contains(fullkey, '[') AND (type <> 'OBJECT' OR j.value::VARCHAR = '{{}}'))"""


def i1_flatten_config(spark, d):
    return _typed(I.flatten_config(_config(_events(spark, d), BASE)))


QUERIES["i1_flatten_config"] = i1_flatten_config
SQL["i1_flatten_config"] = f"WITH {EV}, c AS (SELECT config_id, {_fill_sql(BASE)} AS config FROM ev) SELECT * FROM {leaves_sql('c', 'config')}"

# without nulls, on which the SQL merge function has a meaning of its own
BASE_FULL = BASE.replace(',"eps":null', "")


def i2_merge_configs(spark, d):
    e = _config(_config(_config(_events(spark, d), BASE_FULL, "a"), PATCH_A, "b"), PATCH_B, "c")
    return _typed(I.merge_configs(e, ["a", "b", "c"]))


QUERIES["i2_merge_configs"] = i2_merge_configs
SQL["i2_merge_configs"] = f"""WITH {EV}, c AS (SELECT config_id, json_merge_patch(json_merge_patch({_fill_sql(BASE_FULL)}::JSON, {_fill_sql(PATCH_A)}::JSON), {_fill_sql(PATCH_B)}::JSON) AS config FROM ev)
SELECT * FROM {leaves_sql('c', 'config')}"""


def i3_apply_patch(spark, d):
    e = _config(_config(_events(spark, d), BASE_FULL, "base"), PATCH_A, "patch")
    return _typed(I.apply_patch(e))


QUERIES["i3_apply_patch"] = i3_apply_patch
SQL["i3_apply_patch"] = f"""WITH {EV}, c AS (SELECT config_id, json_merge_patch({_fill_sql(BASE_FULL)}::JSON, {_fill_sql(PATCH_A)}::JSON) AS config FROM ev)
SELECT * FROM {leaves_sql('c', 'config')}"""

OLD = '{"a":{"lr":<value>,"name":"x","same":1,"gone":{"deep":1}},"l":[1,2,3],"m":["p","q"],"z":null,"f":0.25,"swap":{"in":1},"n":-0.5}'
NEW = '{"a":{"lr":0.0005,"name":"<event_type>","same":1},"l":[1,2,3,4],"m":["p"],"f":2500.5,"new":{"k":<k>},"swap":<k>,"b":true,"nil":null}'


def i4_diff_configs(spark, d):
    e = _config(_config(_events(spark, d), OLD, "old"), NEW, "new")
    return I.diff_configs(e)


QUERIES["i4_diff_configs"] = i4_diff_configs


def _diff_nodes(col: str) -> str:
    return f"""(SELECT config_id, fullkey, path AS up, type, j.value::VARCHAR AS v, CASE type WHEN 'OBJECT' THEN '{{...}}'
  WHEN 'ARRAY' THEN CASE WHEN json_array_length(j.value) <= 3 THEN replace(replace(j.value::VARCHAR, ',', ', '), '"', '''') ELSE '[' || json_array_length(j.value) || ' items]' END
  WHEN 'DOUBLE' THEN CASE WHEN j.value::DOUBLE < 0.001 OR j.value::DOUBLE > 1000 THEN printf('%.2e', j.value::DOUBLE) ELSE (j.value::DOUBLE)::VARCHAR END
  WHEN 'BOOLEAN' THEN CASE WHEN j.value::VARCHAR = 'true' THEN 'True' ELSE 'False' END WHEN 'NULL' THEN 'None' WHEN 'VARCHAR' THEN j.value ->> '$' ELSE j.value::VARCHAR END AS txt
 FROM c, json_tree({col}::JSON) j WHERE NOT contains(fullkey, '['))"""


_nodes = lambda side, col: f"SELECT '{side}' AS side, * FROM {_diff_nodes(col)}"
_side = lambda col, side: f"max({col}) FILTER (side = '{side}')"
SQL["i4_diff_configs"] = f"""WITH {EV}, c AS MATERIALIZED (SELECT config_id, {_fill_sql(OLD)} AS old, {_fill_sql(NEW)} AS new FROM ev),
b AS MATERIALIZED (SELECT config_id, fullkey, any_value(up) AS up, {_side('type', 'o')} AS ot, {_side('type', 'n')} AS nt, {_side('v', 'o')} AS ov, {_side('v', 'n')} AS nv,
 {_side('txt', 'o')} AS otx, {_side('txt', 'n')} AS ntx FROM ({_nodes('o', 'old')} UNION ALL {_nodes('n', 'new')}) GROUP BY config_id, fullkey),
p AS (SELECT config_id, list(fullkey) AS objects FROM b WHERE ot = 'OBJECT' AND nt = 'OBJECT' GROUP BY config_id)
SELECT config_id, substr(fullkey, 3) AS path, CASE WHEN ot IS NULL THEN '+ ' || substr(fullkey, 3) || ': ' || ntx WHEN nt IS NULL THEN '- ' || substr(fullkey, 3) || ': ' || otx
  ELSE '  ' || substr(fullkey, 3) || ': ' || otx || ' → ' || ntx END AS line
FROM b JOIN p USING (config_id)
WHERE fullkey <> '$' AND list_contains(objects, up) AND (ot IS DISTINCT FROM nt OR ov <> nv) AND NOT (coalesce(ot, '') = 'OBJECT' AND coalesce(nt, '') = 'OBJECT')
 AND NOT (ot IS NULL AND nt = 'NULL') AND NOT (nt IS NULL AND ot = 'NULL')"""


def i5_config_hash(spark, d):
    return I.config_hash(_config(_events(spark, d), BASE))


QUERIES["i5_config_hash"] = i5_config_hash
SQL["i5_config_hash"] = f"""WITH {EV}, c AS (SELECT config_id, {_fill_sql(BASE)} AS config FROM ev)
SELECT config_id, left(sha256(string_agg(path || '=' || coalesce(value, CASE WHEN type = 'integer' THEN num::BIGINT::VARCHAR ELSE num::VARCHAR END), chr(10) ORDER BY path)), 16) AS config_hash
FROM {leaves_sql('c', 'config')} GROUP BY config_id"""

# configs of fourteen levels, whose leaves differ only at the bottom
_LEVELS = [f"l{i}" for i in range(13)]
DEEP14 = "".join(f'{{"{x}":' for x in _LEVELS) + '{"leaf":<k>,"name":"<event_type>"}' + "}" * len(_LEVELS)
DEEP14_PATCH = "".join(f'{{"{x}":' for x in _LEVELS) + '{"leaf":<user_id>,"more":{"x":true}}' + "}" * len(_LEVELS)


def i1_flatten_deep(spark, d):
    return _typed(I.flatten_config(_config(_events(spark, d), DEEP14)))


def i2_merge_deep(spark, d):
    return _typed(I.merge_configs(_config(_config(_events(spark, d), DEEP14, "a"), DEEP14_PATCH, "b"), ["a", "b"]))


def i4_diff_deep(spark, d):
    return I.diff_configs(_config(_config(_events(spark, d), DEEP14, "old"), DEEP14_PATCH, "new"))


def i5_hash_deep(spark, d):
    return I.config_hash(_config(_events(spark, d), DEEP14))


_PATH = ".".join(_LEVELS)
QUERIES |= {"i1_flatten_deep": i1_flatten_deep, "i2_merge_deep": i2_merge_deep, "i4_diff_deep": i4_diff_deep, "i5_hash_deep": i5_hash_deep}
SQL["i1_flatten_deep"] = f"WITH {EV}, c AS (SELECT config_id, {_fill_sql(DEEP14)} AS config FROM ev) SELECT * FROM {leaves_sql('c', 'config')}"
SQL["i2_merge_deep"] = f"""WITH {EV}, c AS (SELECT config_id, json_merge_patch({_fill_sql(DEEP14)}::JSON, {_fill_sql(DEEP14_PATCH)}::JSON) AS config FROM ev)
SELECT * FROM {leaves_sql('c', 'config')}"""
SQL["i4_diff_deep"] = f"""WITH {EV}
SELECT config_id, '{_PATH}.leaf' AS path, '  {_PATH}.leaf: ' || k || ' → ' || user_id AS line FROM ev WHERE k <> user_id
UNION ALL SELECT config_id, '{_PATH}.name', '- {_PATH}.name: ' || event_type FROM ev
UNION ALL SELECT config_id, '{_PATH}.more', '+ {_PATH}.more: {{...}}' FROM ev"""
SQL["i5_hash_deep"] = f"""WITH {EV}
SELECT config_id, left(sha256('{_PATH}.leaf=' || k || chr(10) || '{_PATH}.name="' || event_type || '"'), 16) AS config_hash FROM ev"""

TUNING = (
    '{"optimizer":{"name":"<opt>","learning_rate":<lr>,"betas":<betas>},"scheduler":{"name":"cosine"<warm>},'
    '"batch":{"train_batch_size":<bs>,"eval_batch_size":16},"regularization":{"dropout":<drop>}<more>}'
)


def broken_tuning(spark, d):
    """Tuning configs of which each seventh kind breaks one rule."""
    k = F.col("k")
    e = _events(spark, d).withColumns(
        {
            "opt": F.when(k % 7 == 1, "invalid_opt").otherwise("adamw"),
            "lr": F.when(k % 7 == 2, "1.0").otherwise("0.005"),
            "bs": F.when(k % 7 == 3, "7").otherwise("8"),
            "warm": F.when(k % 7 == 4, "").otherwise(',"warmup_steps":50'),
            "betas": F.when(k % 7 == 5, "[0.9]").otherwise("[0.9,0.999]"),
            "drop": F.when(k % 7 == 6, '"high"').otherwise("0.1"),
            "more": F.when(k % 5 == 4, ',"colour":"red","size":1').otherwise(""),
        }
    )
    return _config(e, TUNING)


def i6_validate_tuning(spark, d):
    return I.validate(broken_tuning(spark, d), I.TUNING_RULES).select("config_id", "violation")


QUERIES["i6_validate_tuning"] = i6_validate_tuning
SQL["i6_validate_tuning"] = f"""WITH {EV}
SELECT config_id, '[optimizer → name] ''invalid_opt'' is not one of [''adamw'', ''adam'', ''sgd'', ''adafactor'']' AS violation FROM ev WHERE k % 7 = 1
UNION ALL SELECT config_id, '[optimizer → learning_rate] 1.0 is greater than the maximum of 0.01' FROM ev WHERE k % 7 = 2
UNION ALL SELECT config_id, '[batch → train_batch_size] 7 is not one of [1, 2, 4, 8, 16, 32, 64]' FROM ev WHERE k % 7 = 3
UNION ALL SELECT config_id, '[scheduler] ''warmup_steps'' is a required property' FROM ev WHERE k % 7 = 4
UNION ALL SELECT config_id, '[optimizer → betas] [0.9] is too short' FROM ev WHERE k % 7 = 5
UNION ALL SELECT config_id, '[regularization → dropout] ''high'' is not of type ''number''' FROM ev WHERE k % 7 = 6
UNION ALL SELECT config_id, '[(root)] Additional properties are not allowed (''colour'', ''size'' were unexpected)' FROM ev WHERE k % 5 = 4"""

# a schema that is given with the data; each kind of constraint is broken by one kind of event
SCHEMA = """{"type": "object", "required": ["name", "size"], "additionalProperties": false, "properties": {
 "name": {"type": "string", "enum": ["one", "two"]}, "size": {"type": "integer", "minimum": 1, "maximum": 9}, "step": {"type": "integer", "enum": [1, 2, 4]},
 "list": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "string"}},
 "free": {"type": "object", "properties": {"deep": {"type": "object", "properties": {"on": {"type": "boolean"}}}}}}}"""
BROKEN = '{"name":"<name>",<size>"step":<step>,"list":<list>,"free":{"deep":{"on":<on>,"more":1},"any":[]}<extra>}'


def i6_validate_schema(spark, d):
    k = F.col("k") % 10
    e = _events(spark, d).withColumns(
        {
            "name": F.when(k == 1, "six").otherwise("one"),
            "size": F.when(k == 2, "").when(k == 3, '"size":0,').when(k == 4, '"size":10,').otherwise('"size":3,'),
            "step": F.when(k == 5, "3").otherwise("4"),
            "list": F.when(k == 6, "[]").when(k == 7, '["a","b","c"]').when(k == 8, '["a",7]').otherwise('["a"]'),
            "on": F.when(k == 9, "null").otherwise("true"),
            "extra": F.when(F.col("k") % 7 == 0, ',"odd":true').otherwise(""),
        }
    )
    return I.validate(_config(e, BROKEN), SCHEMA).select("config_id", "violation")


QUERIES["i6_validate_schema"] = i6_validate_schema
_broken = (
    ("k % 10 = 1", "[name] 'six' is not one of ['one', 'two']"),
    ("k % 10 = 2", "[(root)] 'size' is a required property"),
    ("k % 10 = 3", "[size] 0 is less than the minimum of 1"),
    ("k % 10 = 4", "[size] 10 is greater than the maximum of 9"),
    ("k % 10 = 5", "[step] 3 is not one of [1, 2, 4]"),
    ("k % 10 = 6", "[list] [] is too short"),
    ("k % 10 = 7", "[list] ['a', 'b', 'c'] is too long"),
    ("k % 10 = 8", "[list → 1] 7 is not of type 'string'"),
    ("k % 10 = 9", "[free → deep → on] None is not of type 'boolean'"),
    ("k % 7 = 0", "[(root)] Additional properties are not allowed ('odd' was unexpected)"),
)
SQL["i6_validate_schema"] = f"WITH {EV} " + " UNION ALL ".join(f"SELECT config_id, {sql_str(m)} AS violation FROM ev WHERE {c}" for c, m in _broken)

AUGS = (
    '{"pipeline":{"enabled":true,"text_augmentations":[{"name":"random_swap","enabled":true,"probability":0.1},'
    '{"name":"<event_type>","enabled":false,"probability":<p>,"max_swaps":<k>}],"data_mixing":{"sources":<src>}}}'
)


def i6_validate_augmentations(spark, d):
    k = F.col("k")
    src = F.when(k % 3 == 0, '["a","b","c","d","e","f"]').otherwise('["a"]')
    e = _events(spark, d).withColumn("p", F.col("value") / 10).withColumn("src", src)
    return I.validate(_config(e, AUGS), I.AUGMENTATION_RULES).select("config_id", "path")


QUERIES["i6_validate_augmentations"] = i6_validate_augmentations
_entry = "pipeline.text_augmentations.1"
SQL["i6_validate_augmentations"] = f"""WITH {EV}
SELECT config_id, '{_entry}.name' AS path FROM ev UNION ALL SELECT config_id, '{_entry}.probability' FROM ev WHERE value / 10 > 1 OR value < 0
UNION ALL SELECT config_id, '{_entry}.max_swaps' FROM ev WHERE k < 1 OR k > 10
UNION ALL SELECT config_id, 'pipeline.data_mixing.sources' FROM ev WHERE k % 3 = 0"""

DEEP = '{"a/x":{"b":{"c":{"d":{"e":<k>}},"l":[<value>,"<event_type>"]}},"long":"<long>","t":true,"none":null}'


def i7_flatten_params(spark, d):
    e = _config(_events(spark, d).withColumn("long", F.repeat("event_type", 60)), DEEP)
    out = I.flatten_params(e)
    return out.select("config_id", "name", I.clean_metric_name(F.col("name")).alias("clean_name"), "value")


QUERIES["i7_flatten_params"] = i7_flatten_params
SQL["i7_flatten_params"] = f"""WITH {EV}, r AS (
SELECT config_id, 'a/x.b.c.d' AS name, '{{''e'': ' || k || '}}' AS value FROM ev
UNION ALL SELECT config_id, 'a/x.b.l', '[' || value || ', ''' || event_type || ''']' FROM ev
UNION ALL SELECT config_id, 'long', left(repeat(event_type, 60), 250) FROM ev
UNION ALL SELECT config_id, 't', 'True' FROM ev UNION ALL SELECT config_id, 'none', 'None' FROM ev)
SELECT config_id, name, replace(name, '/', '.') AS clean_name, value FROM r"""


def responses(spark, d):
    """Conversation turns that answer with fenced configs: none, one, several, broken ones."""
    c = table(spark, d, "conversations", "conv_id", "turn", "text", many_tasks=True)
    m = (F.col("conv_id") + F.col("turn")) % 6
    lr = F.col("turn").cast("string")
    tuning = F.concat(F.lit("\n```yaml\noptimizer:\n  name: adam\n  step: "), lr, F.lit("\n```\n"))
    aug = F.lit("\n```yaml\npipeline:\n  enabled: true\n```\n")
    loose = F.concat(F.lit("\n```\nseed: "), lr, F.lit("\nnote: more\n```\n"))
    broken = F.lit("\n```yaml\n[1, 2\n```\n")
    wrapped = F.concat(F.lit("\n```yaml\ntuning:\n  batch: "), lr, F.lit("\n```\n"))
    text = (
        F.when(m == 1, F.concat("text", tuning))
        .when(m == 2, F.concat("text", aug, F.lit("and"), tuning, F.lit("then"), loose))
        .when(m == 3, F.concat("text", broken, wrapped))
        .when(m == 4, F.concat("text", loose, tuning))
        .when(m == 5, F.concat(F.lit("augmentations:\n  pipeline: "), lr, F.lit("\ntuning: {}\n")))
        .otherwise(F.col("text"))
    )
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("response"), text.alias("text"))


def i8_proposal_blocks(spark, d):
    return I.proposal_blocks(responses(spark, d), "response").select("response", "pos", F.md5("block").alias("block_md5"))


QUERIES["i8_proposal_blocks"] = i8_proposal_blocks
RE = "re AS (SELECT conv_id * 1000 + turn AS response, turn, (conv_id + turn) % 6 AS m FROM conversations)"
_tun = "md5('optimizer:' || chr(10) || '  name: adam' || chr(10) || '  step: ' || turn || chr(10))"
_aug = "md5('pipeline:' || chr(10) || '  enabled: true' || chr(10))"
_loose = "md5('seed: ' || turn || chr(10) || 'note: more' || chr(10))"
_wrap = "md5('tuning:' || chr(10) || '  batch: ' || turn || chr(10))"
SQL["i8_proposal_blocks"] = f"""WITH {RE}
SELECT response, 0 AS pos, {_tun} AS block_md5 FROM re WHERE m = 1
UNION ALL SELECT response, 0, {_aug} FROM re WHERE m = 2 UNION ALL SELECT response, 1, {_tun} FROM re WHERE m = 2 UNION ALL SELECT response, 2, {_loose} FROM re WHERE m = 2
UNION ALL SELECT response, 0, md5('[1, 2' || chr(10)) FROM re WHERE m = 3 UNION ALL SELECT response, 1, {_wrap} FROM re WHERE m = 3
UNION ALL SELECT response, 0, {_loose} FROM re WHERE m = 4 UNION ALL SELECT response, 1, {_tun} FROM re WHERE m = 4"""


def i8_extract_proposals(spark, d):
    return I.extract_proposals(responses(spark, d), "response")


QUERIES["i8_extract_proposals"] = i8_extract_proposals
_opt = """'"optimizer":{"name":"adam","step":' || turn || '}'"""
SQL["i8_extract_proposals"] = f"""WITH {RE}
SELECT response, CASE m WHEN 2 THEN '{{"pipeline": {{"enabled": true}}}}' WHEN 5 THEN '{{"pipeline":' || turn || '}}' ELSE '{{}}' END AS augmentations,
 CASE WHEN m IN (1, 4) THEN '{{' || {_opt} || '}}' WHEN m = 2 THEN '{{"note":"more",' || {_opt} || ',"seed":' || turn || '}}'
  WHEN m = 3 THEN '{{"batch":' || turn || '}}' ELSE '{{}}' END AS tuning FROM re"""

AUG_NAMES = ("random_deletion", "random_swap", "token_cutoff")


def mutation_bases(spark, d):
    e = _events(spark, d).withColumnRenamed("config_id", "candidate")
    augs = F.array(
        *[
            F.struct(F.lit(n).alias("name"), (F.col("k") % (i + 2) == 0).alias("enabled"), F.lit(0.1).alias("probability"))
            for i, n in enumerate(AUG_NAMES)
        ]
    )
    return e.select(
        "candidate",
        (F.col("value") / 10000).alias("learning_rate"),
        augs.alias("augs"),
        F.lit(False).alias("pipeline_enabled"),
        F.lit(8).alias("train_batch_size"),
        F.lit(0.1).alias("dropout"),
        (F.col("k") % 2 == 0).alias("lora_enabled"),
        F.lit(8).alias("lora_rank"),
        F.lit(16).alias("lora_alpha"),
        (F.col("k") < 40).alias("exploring"),
    )


def i9_mutate(spark, d):
    m = I.mutate(mutation_bases(spark, d), lora=True)
    shown = F.array_join(
        F.transform("augs", lambda a: F.concat_ws(":", a["name"], a["enabled"].cast("string"), a["probability"].cast("string"))), ","
    )
    return m.withColumn("augs", shown).drop("exploring")


QUERIES["i9_mutate"] = i9_mutate


def _mutate_sql() -> str:
    d = lambda i: u_sql(42, "mutate", "candidate", i)
    lst = lambda xs: "[" + ", ".join(f"{float(x)!r}::DOUBLE" if isinstance(x, float) else str(x) for x in xs) + "]"
    one = lambda draw, xs: f"({lst(xs)})[floor({draw} * {len(xs)})::INT + 1]"
    between = lambda draw, lo, hi: f"round({lo}::DOUBLE + {draw} * {hi - lo}::DOUBLE, 2)"
    augs = ", ".join(f"{{'n': '{n}', 'e': k % {i + 2} = 0, 'p': 0.1::DOUBLE}}" for i, n in enumerate(AUG_NAMES))
    return f"""
WITH {EV}, b AS (SELECT config_id AS candidate, value / 10000 AS lr, [{augs}] AS augs, k, k < 40 AS exploring, k % 2 = 0 AS lora FROM ev),
m AS (SELECT *, floor({d(1)} * 3)::INT + 1 AS slot, greatest(1e-7::DOUBLE, least(1e-2::DOUBLE, lr * CASE WHEN exploring THEN {one(d(0), I.EXPLORE_FACTORS)} ELSE {one(d(0), I.EXPLOIT_FACTORS)} END)) AS learning_rate,
  CASE WHEN {d(3)} < 0.3::DOUBLE THEN {one(d(4), I.BATCH_SIZES)} ELSE 8 END::INT AS train_batch_size,
  CASE WHEN {d(5)} < 0.3::DOUBLE THEN {between(d(6), 0.0, 0.4)} ELSE 0.1::DOUBLE END AS dropout, {d(7)} < 0.2::DOUBLE AS turn FROM b),
f AS (SELECT *, list_transform(augs, lambda a, i: CASE WHEN i = slot THEN {{'n': a.n, 'e': NOT a.e, 'p': CASE WHEN NOT a.e THEN {between(d(2), 0.05, 0.3)} ELSE a.p END}} ELSE a END) AS na FROM m),
g AS (SELECT *, CASE WHEN turn THEN NOT lora ELSE lora END AS lora_enabled FROM f)
SELECT candidate, learning_rate, array_to_string(list_transform(na, lambda a: a.n || ':' || a.e::VARCHAR || ':' || a.p::VARCHAR), ',') AS augs,
 len(list_filter(na, lambda a: a.e)) > 0 AS pipeline_enabled, train_batch_size, dropout, lora_enabled,
 CASE WHEN turn AND lora_enabled THEN {one(d(8), I.LORA_RANKS)} ELSE 8 END::INT AS lora_rank,
 CASE WHEN turn AND lora_enabled THEN {one(d(8), I.LORA_RANKS)} * 2 ELSE 16 END::INT AS lora_alpha FROM g"""


SQL["i9_mutate"] = _mutate_sql()


MUTATION_AUGS = '{"pipeline":{"enabled":true,"text_augmentations":[{"name":"random_swap","enabled":<flag>,"probability":0.1,"max_swaps":3}],"note":"<event_type>"}}'
MUTATION_TUNING = (
    '{"optimizer":{"name":"adamw","learning_rate":0.001},"batch":{"train_batch_size":8},"regularization":{"dropout":0.1},"lora":{"enabled":false,"rank":8,"alpha":16},"seed":<k>}'
)


def i9_mutate_configs(spark, d):
    """Three neighbours of every config, as configs; what a mutation leaves alone is still there."""
    e = _events(spark, d).withColumn("flag", F.when(F.col("k") % 2 == 0, "true").otherwise("false"))
    e = _config(_config(e, MUTATION_AUGS, "augmentations"), MUTATION_TUNING, "tuning")
    m = I.mutate_configs(e, 3, exploring=F.col("k") < 40, lora=True)
    t = lambda p, kind: F.get_json_object("tuning", p).cast(kind)
    a = lambda p, kind: F.get_json_object("augmentations", f"$.pipeline.{p}").cast(kind)
    # which of equal neighbours is kept does not matter here
    return m.select(
        "config_id", t("$.optimizer.learning_rate", "double").alias("learning_rate"), t("$.optimizer.name", "string").alias("optimizer"),
        t("$.batch.train_batch_size", "int").alias("batch"), t("$.regularization.dropout", "double").alias("dropout"), t("$.lora.enabled", "boolean").alias("lora_enabled"),
        t("$.lora.rank", "int").alias("lora_rank"), t("$.lora.alpha", "int").alias("lora_alpha"), t("$.seed", "int").alias("seed"), a("enabled", "boolean").alias("enabled"),
        a("note", "string").alias("note"), a("text_augmentations[0].enabled", "boolean").alias("aug_enabled"),
        a("text_augmentations[0].probability", "double").alias("probability"), a("text_augmentations[0].max_swaps", "int").alias("max_swaps"),
    )


QUERIES["i9_mutate_configs"] = i9_mutate_configs


def _mutate_configs_sql() -> str:
    d = lambda i: u_sql(42, "mutate", "candidate", i)
    lst = lambda xs: "[" + ", ".join(f"{float(x)!r}::DOUBLE" if isinstance(x, float) else str(x) for x in xs) + "]"
    one = lambda draw, xs: f"({lst(xs)})[floor({draw} * {len(xs)})::INT + 1]"
    between = lambda draw, lo, hi: f"round({lo}::DOUBLE + {draw} * {hi - lo}::DOUBLE, 2)"
    return f"""
WITH {EV}, b AS (SELECT config_id, config_id || '/' || i AS candidate, k, event_type, k < 40 AS exploring FROM ev, range(3) AS r(i)),
m AS (SELECT *, greatest(1e-7::DOUBLE, least(1e-2::DOUBLE, 0.001::DOUBLE * CASE WHEN exploring THEN {one(d(0), I.EXPLORE_FACTORS)} ELSE {one(d(0), I.EXPLOIT_FACTORS)} END)) AS learning_rate,
  CASE WHEN {d(3)} < 0.3::DOUBLE THEN {one(d(4), I.BATCH_SIZES)} ELSE 8 END::INT AS batch,
  CASE WHEN {d(5)} < 0.3::DOUBLE THEN {between(d(6), 0.0, 0.4)} ELSE 0.1::DOUBLE END AS dropout, {d(7)} < 0.2::DOUBLE AS lora_enabled, k % 2 <> 0 AS aug_enabled FROM b)
SELECT DISTINCT config_id, learning_rate, 'adamw' AS optimizer, batch, dropout, lora_enabled, CASE WHEN lora_enabled THEN {one(d(8), I.LORA_RANKS)} ELSE 8 END::INT AS lora_rank,
 CASE WHEN lora_enabled THEN {one(d(8), I.LORA_RANKS)} * 2 ELSE 16 END::INT AS lora_alpha, k AS seed, aug_enabled AS enabled, event_type AS note, aug_enabled,
 CASE WHEN aug_enabled THEN {between(d(2), 0.05, 0.3)} ELSE 0.1::DOUBLE END AS probability, 3::INT AS max_swaps FROM m"""


SQL["i9_mutate_configs"] = _mutate_configs_sql()


def i10_accept_proposals(spark, d):
    p = broken_tuning(spark, d)
    v = I.validate(p, I.TUNING_RULES)
    rows = p.select("config_id", F.col("config").alias("proposed"), F.lit("{}").alias("current"))
    return I.accept_proposals(rows, v).select("config_id", F.length("config").cast("bigint").alias("n_chars"), "accepted")


QUERIES["i10_accept_proposals"] = i10_accept_proposals
_valid = TUNING.replace("<opt>", "adamw").replace("<lr>", "0.005").replace("<betas>", "[0.9,0.999]").replace("<warm>", ',"warmup_steps":50').replace(
    "<bs>", "8"
).replace("<drop>", "0.1").replace("<more>", "")
SQL["i10_accept_proposals"] = (
    f"WITH {EV} SELECT config_id, CASE WHEN k % 7 = 0 AND k % 5 <> 4 THEN {len(_valid)} ELSE 2 END::BIGINT AS n_chars, k % 7 = 0 AND k % 5 <> 4 AS accepted FROM ev"
)


def j7_grid(spark, d):
    """Hyperparameter grid around one base config per supplier, with its hash."""
    bases = table(spark, d, "supplier", "s_suppkey")
    g = I.grid(bases, {"optimizer": ["adamw", "adam", "sgd"], "batch": [4, 8, 16], "lr": [1e-4, 1e-3]})
    line = F.concat_ws("|", F.col("s_suppkey").cast("string"), "optimizer", F.col("batch").cast("string"), (F.col("lr") * 10000).cast("int").cast("string"))
    return g.withColumn("config_hash", F.left(F.sha2(line, 256), F.lit(16)))


QUERIES["j7_grid"] = j7_grid
SQL["j7_grid"] = """
SELECT s_suppkey, optimizer, batch::INT AS batch, lr, left(sha256(concat_ws('|', s_suppkey, optimizer, batch, (lr * 10000)::INT)), 16) AS config_hash
FROM supplier, (SELECT unnest(['adamw', 'adam', 'sgd']) AS optimizer), (SELECT unnest([4, 8, 16]) AS batch), (SELECT unnest([0.0001::DOUBLE, 0.001::DOUBLE]) AS lr)"""
