import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from trialweave.functions.numbers import fixed, short_float
from trialweave.operators import configs as I
from trialweave.plans.session import spread
from trialweave.sources.configs import read_config_files, read_configs

TUNING = {
    "optimizer": {"name": "adamw", "learning_rate": 5e-05, "weight_decay": 0.01, "betas": [0.9, 0.999], "eps": 1e-08, "momentum": 0.9},
    "scheduler": {"name": "cosine", "warmup_steps": 50, "num_cycles": 1},
    "batch": {"train_batch_size": 8, "eval_batch_size": 16, "gradient_accumulation_steps": 1},
    "regularization": {"dropout": 0.1, "attention_dropout": 0.1, "label_smoothing": 0.0, "max_grad_norm": 1.0},
    "lora": {"enabled": False, "rank": 8, "alpha": 16, "target_modules": ["q_proj", "v_proj"], "dropout": 0.05, "bias": "none"},
}
AUGMENTATION = {
    "pipeline": {
        "enabled": False,
        "text_augmentations": [{"name": "random_swap", "enabled": False, "probability": 0.05, "max_swaps": 1}],
        "image_augmentations": [{"name": "mixup", "enabled": False, "probability": 0.2, "alpha": 0.4}],
        "data_mixing": {"enabled": False, "sources": [], "mix_ratio": 0.1},
    }
}


def table(spark, *configs):
    return spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(configs)], "config_id bigint, config string")


def changed(config, path, value):
    out = copy.deepcopy(config)
    at = out
    *above, last = path
    for p in above:
        at = at[p]
    at[last] = value
    return out


def test_validation(spark):
    bad = [
        TUNING,
        changed(TUNING, ("optimizer", "learning_rate"), 1.0),
        changed(TUNING, ("optimizer", "name"), "invalid_opt"),
        changed(TUNING, ("batch", "train_batch_size"), 7),
        changed(TUNING, ("batch", "train_batch_size"), 8.0),
        changed(TUNING, ("lora", "enabled"), 1),
        changed(TUNING, ("lora",), 3),
        {k: v for k, v in TUNING.items() if k not in ("batch", "scheduler")},
        changed(TUNING, ("lora", "target_modules"), ["a", 3, True]),
        changed(TUNING, ("optimizer", "learning_rate"), 1e-09),
    ]
    got = {}
    for r in I.validate(table(spark, *bad), I.TUNING_RULES).collect():
        got.setdefault(r.config_id, set()).add(r.violation)
    assert got == {
        1: {"[optimizer → learning_rate] 1.0 is greater than the maximum of 0.01"},
        2: {"[optimizer → name] 'invalid_opt' is not one of ['adamw', 'adam', 'sgd', 'adafactor']"},
        3: {"[batch → train_batch_size] 7 is not one of [1, 2, 4, 8, 16, 32, 64]"},
        5: {"[lora → enabled] 1 is not of type 'boolean'"},
        6: {"[lora] 3 is not of type 'object'"},
        7: {"[(root)] 'scheduler' is a required property", "[(root)] 'batch' is a required property"},
        8: {"[lora → target_modules → 1] 3 is not of type 'string'", "[lora → target_modules → 2] True is not of type 'string'"},
        9: {"[optimizer → learning_rate] 1e-09 is less than the minimum of 1e-07"},
    }
    entry = ("pipeline", "text_augmentations", 0, "probability")
    rows = I.validate(table(spark, AUGMENTATION, changed(AUGMENTATION, entry, 1.5), changed(AUGMENTATION, entry[:3], {"name": "random_swap", "x": 1})), I.AUGMENTATION_RULES).collect()
    assert sorted((r.config_id, r.violation) for r in rows) == [
        (1, "[pipeline → text_augmentations → 0 → probability] 1.5 is greater than the maximum of 1.0"),
        (2, "[pipeline → text_augmentations → 0] 'enabled' is a required property"),
        (2, "[pipeline → text_augmentations → 0] 'probability' is a required property"),
        (2, "[pipeline → text_augmentations → 0] Additional properties are not allowed ('x' was unexpected)"),
    ]


def rand_config(rnd, depth=0):
    out = {}
    for k in rnd.sample("abcd", rnd.randint(0 if depth else 1, 3)):
        kind = rnd.random()
        if kind < 0.45 and depth < 3:
            out[k] = rand_config(rnd, depth + 1)
        else:
            out[k] = rnd.choice([1, 2, 0.5, -3.25, "x", "y", True, False, None, [1, 2], ["p"], []])
    return out


def deep(base, over):
    out = dict(base)
    for k, v in over.items():
        out[k] = deep(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def leaves(c, prefix=""):
    out = {}
    for k, v in c.items():
        if isinstance(v, dict) and v:
            out.update(leaves(v, f"{prefix}{k}."))
        else:
            out[f"{prefix}{k}"] = v
    return out


def test_merge_equals_deep_merge(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for i in range(300):
        a, b, c = (rand_config(rnd) for _ in range(3))
        rows.append((i, json.dumps(a), json.dumps(b), json.dumps(c)))
        want[i] = leaves(deep(deep(a, b), c))
    df = spark.createDataFrame(rows, "config_id int, a string, b string, c string")
    got = {i: {} for i in want}
    for r in I.merge_configs(df, ["a", "b", "c"]).collect():
        got[r.config_id][r.path] = json.loads(r.value)
    assert got == want


def test_patch_cases(spark):
    df = spark.createDataFrame([(0, '{"x":1,"y":2}', '{"y":3,"z":4}'), (1, '{"a":{"b":1,"c":2}}', '{"a":{"b":10}}')], "config_id int, base string, patch string")
    got = {(r.config_id, r.path): r.num for r in I.apply_patch(df).collect()}
    assert got == {(0, "x"): 1.0, (0, "y"): 3.0, (0, "z"): 4.0, (1, "a.b"): 10.0, (1, "a.c"): 2.0}


def text(v):
    if isinstance(v, dict):
        return "{...}"
    if isinstance(v, list):
        return str(v) if len(v) <= 3 else f"[{len(v)} items]"
    if isinstance(v, float):
        return f"{v:.2e}" if v < 0.001 or v > 1000 else str(v)
    return str(v)


def lines(a, b, prefix=""):
    out = set()
    for k in sorted({*a, *b}):
        x, y = a.get(k), b.get(k)
        if x == y and type(x) is type(y):
            continue
        if isinstance(x, dict) and isinstance(y, dict):
            out |= lines(x, y, f"{prefix}{k}.")
        elif k not in a:
            out |= {f"+ {prefix}{k}: {text(y)}"} if y is not None else set()
        elif k not in b:
            out |= {f"- {prefix}{k}: {text(x)}"} if x is not None else set()
        else:
            out.add(f"  {prefix}{k}: {text(x)} → {text(y)}")
    return out


def test_diff_equals_a_recursive_walk(spark):
    rnd = random.Random(12)
    rows, want = [], {}
    for i in range(300):
        a, b = rand_config(rnd), rand_config(rnd)
        rows.append((i, json.dumps(a), json.dumps(b)))
        want[i] = lines(a, b)
    rows.append((300, json.dumps(TUNING), json.dumps(TUNING)))
    want[300] = set()
    rows.append((301, json.dumps(TUNING), json.dumps(changed(TUNING, ("optimizer", "learning_rate"), 1e-04))))
    want[301] = {"  optimizer.learning_rate: 5.00e-05 → 1.00e-04"}
    got = {i: set() for i in want}
    for r in I.diff_configs(spark.createDataFrame(rows, "config_id int, old string, new string")).collect():
        got[r.config_id].add(r.line)
    assert got == want


def test_loose_diff(spark):
    df = spark.createDataFrame([(0, '{"a":1,"b":1,"c":2}', '{"a":1.0,"b":true,"c":3}')], "config_id int, old string, new string")
    assert [r.path for r in I.diff_configs(df, loose=True).collect()] == ["c"]
    assert I.diff_configs(df).count() == 3


def test_hash(spark):
    other = changed(TUNING, ("optimizer", "learning_rate"), 1e-04)
    shuffled = dict(reversed(list(TUNING.items())))
    h = {r.config_id: r.config_hash for r in I.config_hash(table(spark, TUNING, other, shuffled)).collect()}
    assert h[0] == h[2] != h[1] and len(h[0]) == 16


def test_numbers(spark):
    rnd = random.Random(1)
    xs = [0.125, 0.375, 2.5, -0.5, 0.05, 1e-5, 5e-05, 1e16, 1.5e7, 123456789.0, 0.0001, -1e-7, 1000.0]
    xs += [rnd.randint(-(10**7), 10**7) / 10 ** rnd.randint(0, 6) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (1, 2, 4):
        assert all(r.f == f"{r.x:.{d}f}" for r in df.select("x", fixed(F.col("x"), d).alias("f")).collect())
    assert [r.s for r in df.select(short_float(F.col("x")).alias("s")).limit(13).collect()] == [repr(x) for x in xs[:13]]


def test_config_files(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("optimizer:\n  name: adam\n  betas: [0.9, 0.999]\n")
    (tmp_path / "b.yaml").write_text("- no\n- mapping\n")
    got = read_config_files(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].config_id.endswith("a.yaml")
    assert json.loads(got[0].config) == {"optimizer": {"name": "adam", "betas": [0.9, 0.999]}}


def test_yaml_and_proposals(spark):
    docs = spark.createDataFrame([(0, "a: 1\nb: {c: x}"), (1, "- 1"), (2, "a: [1"), (3, "")], "config_id int, config string")
    assert [(r.config_id, json.loads(r.config)) for r in read_configs(docs, fmt="yaml").collect()] == [(0, {"a": 1, "b": {"c": "x"}})]
    fence = "```"
    answers = [
        f"text\n{fence}yaml\npipeline: {{enabled: true}}\n{fence}\nmore\n{fence}\nbatch: {{train_batch_size: 4}}\n{fence}",
        f"{fence}yaml\nseed: 1\n{fence}\n{fence}yaml\noptimizer: {{name: sgd}}\n{fence}\n{fence}yaml\nseed: 2\n{fence}",
        f"{fence}yaml\naugmentations: {{pipeline: {{enabled: false}}}}\n{fence}\n{fence}yaml\ntuning: {{batch: 2}}\n{fence}",
        "augmentations: {pipeline: {enabled: true}}\ntuning: {batch: 3}",
        "nothing to read here",
        f"{fence}yaml\n[broken\n{fence}",
    ]
    df = spark.createDataFrame(list(enumerate(answers)), "response int, text string")
    got = {r.response: (json.loads(r.augmentations), json.loads(r.tuning)) for r in I.extract_proposals(df, "response").collect()}
    assert got == {
        0: ({"pipeline": {"enabled": True}}, {"batch": {"train_batch_size": 4}}),
        1: ({}, {"optimizer": {"name": "sgd"}, "seed": 2}),
        2: ({"pipeline": {"enabled": False}}, {"batch": 2}),
        3: ({"pipeline": {"enabled": True}}, {"batch": 3}),
        4: ({}, {}),
        5: ({}, {}),
    }


@pytest.mark.parametrize("exploring,factors", [(True, I.EXPLORE_FACTORS), (False, I.EXPLOIT_FACTORS)])
def test_mutation_bounds(spark, exploring, factors):
    base = spark.range(400).select(
        F.col("id").alias("candidate"), F.lit(5e-3).alias("learning_rate"),
        F.array(F.struct(F.lit("a").alias("name"), F.lit(False).alias("enabled"), F.lit(0.5).alias("probability"))).alias("augs"),
        F.lit(False).alias("pipeline_enabled"), F.lit(8).alias("train_batch_size"), F.lit(0.1).alias("dropout"), F.lit(exploring).alias("exploring"),
    )
    rows = I.mutate(base).collect()
    allowed = {max(1e-7, min(1e-2, 5e-3 * f)) for f in factors}
    assert {r.learning_rate for r in rows} == allowed
    assert all(r.augs[0].enabled and 0.05 <= r.augs[0].probability <= 0.3 and r.pipeline_enabled for r in rows)
    assert {r.train_batch_size for r in rows} == {2, 4, 8, 16, 32} and all(0 <= r.dropout <= 0.4 for r in rows)


@pytest.mark.parametrize("depth", [9, 20, 60])
def test_any_depth(spark, depth):
    def nest(leaf, d):
        return {"k": nest(leaf, d - 1)} if d else leaf

    a, b = nest({"x": 1}, depth), nest({"x": 2, "text": 'braces "{[" in strings'}, depth)
    df = table(spark, a, b)
    path = ".".join(["k"] * depth)
    leaves = {(r.config_id, r.path) for r in I.flatten_config(df).collect()}
    assert leaves == {(0, f"{path}.x"), (1, f"{path}.x"), (1, f"{path}.text")}
    assert len({r.config_hash for r in I.config_hash(df).collect()}) == 2
    pair = spark.createDataFrame([(0, json.dumps(a), json.dumps(b))], "config_id bigint, old string, new string")
    assert {r.path for r in I.diff_configs(pair).collect()} == {f"{path}.x", f"{path}.text"}
    assert {(r.path, r.value) for r in I.merge_configs(pair, ["old", "new"]).collect()} >= {(f"{path}.x", "2")}


def test_schema_documents(spark):
    schema = {"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "integer", "minimum": 2}}, "additionalProperties": False}}}
    bad = I.validate(table(spark, {"a": {"b": 1, "c": 0}, "free": 1}, {"a": {"b": 2}}), schema).select("config_id", "violation").collect()
    assert sorted(map(tuple, bad)) == [
        (0, "[a → b] 1 is less than the minimum of 2"),
        (0, "[a] Additional properties are not allowed ('c' was unexpected)"),
    ]
    for wrong in ({}, "null", "[1]", {"type": "thing"}, {"type": "string", "pattern": "x"}, {"properties": {"a.b": {"type": "string"}}}):
        with pytest.raises(ValueError):
            I.compile_schema(wrong)


def test_compiled_schema_equals_rules(spark):
    schema = {"type": "object", "required": ["n"], "additionalProperties": False, "properties": {"n": {"type": "number", "minimum": 0, "maximum": 1}}}
    assert I.compile_schema(json.dumps(schema)) == (("", "object", {"req": ("n",)}), ("n", "number", {"range": (0, 1), "open": True}))


def test_neighbours_of_configs(spark):
    rows = [(1, json.dumps(AUGMENTATION), json.dumps(TUNING)), (2, json.dumps({"pipeline": {"enabled": True}}), json.dumps({"optimizer": {"learning_rate": 0.01}}))]
    df = spark.createDataFrame(rows, "config_id bigint, augmentations string, tuning string")
    out = I.mutate_configs(df, 8, lora=True).collect()
    assert len({r.config_hash for r in out}) == len(out) > 8
    one = [r for r in out if r.config_id == 1]
    for r in one:
        tuning, augs = json.loads(r.tuning), json.loads(r.augmentations)
        assert tuning["scheduler"] == TUNING["scheduler"] and tuning["optimizer"]["betas"] == [0.9, 0.999]
        assert 1e-7 <= tuning["optimizer"]["learning_rate"] <= 1e-2
        assert augs["pipeline"]["image_augmentations"] == AUGMENTATION["pipeline"]["image_augmentations"]
        assert augs["pipeline"]["text_augmentations"][0]["enabled"] is True and augs["pipeline"]["enabled"] is True
    two = [json.loads(r.tuning) for r in out if r.config_id == 2]
    assert all(set(t) <= {"optimizer", "batch", "regularization", "lora"} and t["optimizer"]["learning_rate"] <= 0.01 for t in two)
    again = I.mutate_configs(df, 8, spark.createDataFrame([(r.config_hash,) for r in one], "config_hash string"), lora=True).collect()
    assert {r.config_id for r in again} == {2}


def test_unreadable_yaml_is_no_config(spark):
    texts = ["a: 1", None, "when: 2024-13-45", "{", "1: {2: x}", "- 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "config_id bigint, config string")
    assert {r.config_id for r in read_configs(df, fmt="yaml").collect()} >= {0}


def test_depth_and_broken_configs(spark):
    """Deep and broken configs next to flat ones: each has its own nodes, and broken ones none."""
    deep_one = {"leaf": 1}
    for i in range(300):
        deep_one = {f"k{i % 3}": deep_one, **({"side": i} if i % 100 == 0 else {})}
    rows = [(0, '{"a":1}', '{"a":2}'), (1, "{" * 10_000, '{"a":1}'), (2, json.dumps(deep_one), '{"a":1}'), (3, None, None), (4, "[[1,{}]]", "7"), (5, '{"a":1,"a":2}', "{}")]
    df = spark.createDataFrame(rows, "config_id int, config string, other string")
    got = {}
    for r in I.flatten_config(df).collect():
        got.setdefault(r.config_id, {})[r.path] = json.loads(r.value)
    assert got == {0: {"a": 1}, 2: leaves(deep_one)}
    assert {r.config_id for r in I.config_nodes(df, "config_id", arrays=True).collect()} == {0, 2, 4}
    lines = {(r.config_id, r.line) for r in I.diff_configs(df, "config", "other").collect()}
    assert (0, "  a: 1 → 2") in lines and {i for i, _ in lines} == {0, 2}
    left = [(r.config_id, r.path) for r in I.merge_configs(df, ["config", "other"]).collect()]
    assert sorted(p for i, p in left if i == 2) == sorted([*leaves(deep_one), "a"]) and (1, "a") in left


def test_params_as_python_writes_them(spark):
    config = {"a": {"b": {"c": {"d": {"z": 1.0, "e": [1e-07, None, "x'y"]}}, "none": {}}}, "t": True, "n": None, "l": ["q", {"k": False}]}
    df = spark.createDataFrame([(1, json.dumps(config)), (2, "[1]"), (3, "{")], "config_id int, config string")
    got = {r.name: r.value for r in I.flatten_params(df).collect()}
    assert got == {"a.b.c.d": str(config["a"]["b"]["c"]["d"]), "t": "True", "n": "None", "l": str(config["l"])}


def test_texts_that_are_no_config_have_no_nodes(spark):
    texts = [None, "", '{"a":1} more', '{"a":1,"a":2}', '{"a":NaN}', "{\"a\":\"\n\"}", '{"a":01}', "[" * 1200 + "]" * 1200, "{", '{"a":[1,{"b":"x\\n"}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "config_id int, config string")
    schema = '{"type": "object", "additionalProperties": false, "properties": {"b": {"type": "string"}}}'
    assert [r.config_id for r in I.validate(df, schema).collect()] == [9]
    assert {r.config_id for r in I.flatten_config(df).collect()} == {9}
    assert {r.config_id for r in I.flatten_params(df).collect()} == {9}
    assert I.diff_configs(df.select("config_id", F.col("config").alias("old"), F.lit('{"a":1}').alias("new"))).count() == 1
    assert [r.raw for r in df.select(F.explode(I._unfolded(arrays=True, whole=True)(F.col("config"))).alias("n")).select("n.raw").collect()] == [
        texts[9], '[1,{"b":"x\\n"}]', '{"b":"x\\n"}', '"x\\n"', "1",
    ]


def test_neighbours_are_worked_out_once(spark):
    df = spark.createDataFrame([(i, '{"pipeline":{"enabled":true}}', '{"optimizer":{"learning_rate":0.001}}') for i in range(5)], "config_id int, augmentations string, tuning string")
    plan = I.mutate_configs(df, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "parseJson" not in plan


def test_a_file_of_one_row_group_is_many_tasks(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": list(range(1000)), "x": [f"{i:08d}" * 40 for i in range(1000)]}), str(tmp_path / "t.parquet"), compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = spark.read.parquet(str(tmp_path / "t.parquet"))
        assert df.rdd.getNumPartitions() > 1
        assert spread(df).groupBy(F.spark_partition_id()).count().count() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
