"""Configs as data: many JSON configs at once, as rows of paths and values."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import pick, u
from ..functions.numbers import short_float
from ..plans.session import materialize

OBJECT = "object"


_KINDS = {"VOID": "null", "OBJECT": OBJECT, "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer"}


def _kind(v: Column) -> Column:
    """The kind of a value; every fractional type is a 'number'. One look at the value."""
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)), F.lit("number"))


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _number(v: Column, kind: Column | None = None) -> Column:
    kind = _kind(v) if kind is None else kind
    return F.when(kind.isin("integer", "number"), F.try_variant_get(v, "$", "double"))


def _shown(v: Column, quote: bool, kind: Column | None = None) -> Column:
    """A value as a Python user writes it."""
    kind = _kind(v) if kind is None else kind
    text = F.try_variant_get(v, "$", "string")
    quoted = F.concat(F.lit("'"), text, F.lit("'"))
    return (
        F.when(kind == "null", "None")
        .when(kind == "boolean", F.initcap(text))
        .when(kind == "string", quoted if quote else text)
        .when(kind == "number", short_float(F.try_variant_get(v, "$", "double")))
        .otherwise(text)
    )


def _list_text(v: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(_as_array(v), lambda x: _shown(x, True)), ", "), F.lit("]"))


# -- nodes ------------------------------------------------------------------------------
#
# A config is unfolded in one pass over its text, by Arrow batches, so that neither the plan nor the number of jobs depends on how deep configs go; values stay
# text until Spark parses them. Only configs that Spark's parser takes get that far.


class _Number(str):
    """A number as it is written."""

    __slots__ = ()


_quoted = json.encoder.encode_basestring_ascii


class _BROKEN:
    """Stands for a text that is no config; a class, as it is the same one in every process."""



def _object(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a name that comes twice")
    return out


def _no_json(name: str):
    raise ValueError(name)


# takes what Spark's parser takes: no name twice in an object, no NaN and the like
_exact = json.JSONDecoder(parse_float=_Number, parse_int=_Number, parse_constant=_no_json, object_pairs_hook=_object).decode
_python = json.JSONDecoder(parse_constant=_no_json, object_pairs_hook=_object).decode


def _load(text: str | None, decode: Callable = _exact):
    """A config, or ``_BROKEN`` for a null or a text that does not parse."""
    try:
        return _BROKEN if text is None else decode(text)
    except (ValueError, RecursionError):
        return _BROKEN


def _dump(v) -> str:
    if type(v) is _Number:
        return str(v)
    if isinstance(v, dict):
        return "{" + ",".join([f"{_quoted(k)}:{_dump(x)}" for k, x in v.items()]) + "}"
    if isinstance(v, list):
        return "[" + ",".join([_dump(x) for x in v]) + "]"
    if isinstance(v, str):
        return _quoted(v)
    return "null" if v is None else "true" if v is True else "false" if v is False else json.dumps(v)


def _plain(name: str) -> str:
    """A member's name without halves of surrogate pairs, which Arrow can't hold."""
    return name if name.isascii() else name.encode("utf-8", "replace").decode("utf-8")


def _walk(config, arrays: bool = False) -> Iterator[tuple[str, str, str, str, object]]:
    """(path, pattern, parent, name, value) of every node, each after its parent."""
    todo = [("", "", "", "", config)]
    while todo:
        node = todo.pop()
        yield node
        path, pattern, _, _, value = node
        if isinstance(value, dict):
            for k, v in value.items():
                k = _plain(k)
                todo.append((f"{path}.{k}" if path else k, f"{pattern}.{k}" if pattern else k, path, k, v))
        elif arrays and isinstance(value, list):
            todo += [(f"{path}.{i}", f"{pattern}[]", path, str(i), v) for i, v in enumerate(value)]


def _sketch(v) -> str:
    """A value as text; of an object only whether it has members, as these are nodes of their own."""
    return ('{"":null}' if v else "{}") if isinstance(v, dict) else _dump(v)


#: Levels of nesting that Spark's JSON parser takes.
NESTING = 1000


def _per_row(names: Sequence[str], f: Callable) -> Callable:
    """A function from JSON texts (nulls or broken ones, where Spark can't parse them) to tuples of texts as a column function; its arrays are made of one Arrow column per name."""
    kind = f"array<struct<{','.join(f'{n}:string' for n in names)}>>"

    def run(*texts: pa.Array) -> pa.Array:
        old = sys.getrecursionlimit()
        sys.setrecursionlimit(max(old, 20_000))
        try:
            ends, made = [0], []
            for row in zip(*(t.to_pylist() for t in texts)):
                made += f(*row)
                ends.append(len(made))
        finally:
            sys.setrecursionlimit(old)
        columns = zip(*made) if made else [()] * len(names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(names)))

    def of(*configs: Column) -> Column:
        # Spark sets up a parser for every text, which takes longer than to read a short one; a text too short for the nesting it refuses is judged by ``_load``
        return F.arrow_udf(run, kind)(*[F.when((F.length(c) < NESTING) | F.try_parse_json(c).isNotNull(), c) for c in configs])

    return of


_NODE = ("path", "pattern", "parent", "name", "raw")


def _unfolded(arrays: bool = False, whole: bool = False) -> Callable:
    """The nodes of a config as an array; with ``whole`` objects come with all they hold."""
    def nodes(text):
        config = _load(text)
        if config is _BROKEN:
            return []
        found = list(_walk(config, arrays))
        if not whole:
            return [(*head, _sketch(v)) for *head, v in found]
        # a node comes after its parent, so from the end on all it holds is written already
        made: dict[int, str] = {}

        def show(v) -> str:
            if isinstance(v, dict) and v:
                return "{" + ",".join([f"{_quoted(k)}:{made[id(x)] if id(x) in made else _dump(x)}" for k, x in v.items()]) + "}"
            if isinstance(v, list) and v:
                return "[" + ",".join([made[id(x)] if id(x) in made else _dump(x) for x in v]) + "]"
            return _dump(v)

        for *_, v in reversed(found):
            if isinstance(v, (dict, list)):
                made[id(v)] = show(v)
        return [(*head, made[id(v)] if id(v) in made else _dump(v)) for *head, v in found]

    return _per_row(_NODE, nodes)


def config_nodes(df: DataFrame, key: Sequence[str], config: str = "config", arrays: bool = False) -> DataFrame:
    """One row per node of every config: (key, path, pattern, parent, name, type, v); a config that does not parse has none.

    ``pattern`` is the path with ``[]`` in place of list positions. Lists are leaves unless
    ``arrays``.
    """
    key = [key] if isinstance(key, str) else list(key)
    rows = df.select(*key, F.explode(_unfolded(arrays, whole=True)(F.col(config))).alias("n"))
    return _typed(rows.select(*key, "n.*"), key)


def _typed(nodes: DataFrame, key: list[str]) -> DataFrame:
    nodes = nodes.withColumn("v", F.try_parse_json("raw")).withColumn("type", _raw_kind(F.col("raw")))
    return nodes.select(*key, *[c for c in ("path", "pattern", "parent", "name") if c in nodes.columns], "type", "v")


# What follows reads the texts that ``_dump`` and ``_sketch`` write. Kind and value of a plain one are seen from its characters; only lists, strings with escapes and
# numbers about as long as the largest integer are parsed.


def _raw_kind(raw: Column) -> Column:
    """``_kind`` of a value's text."""
    first = F.substring(raw, 1, 1)
    return (
        F.when(first == '"', "string")
        .when(first == "{", OBJECT)
        .when(first == "[", "array")
        .when(first.isin("t", "f"), "boolean")
        .when(first == "n", "null")
        .when(raw.rlike("^-?[0-9]{1,18}$"), "integer")
        .when(raw.rlike("^-?[0-9]{19}$"), _kind(F.try_parse_json(raw)))
        .otherwise("number")
    )


def _raw_number(raw: Column, kind: Column) -> Column:
    return F.when(kind.isin("integer", "number"), raw.try_cast("double"))


def _plain_string(raw: Column, kind: Column) -> Column:
    return (kind == "string") & ~F.contains(raw, F.lit("\\"))


def _inner(raw: Column) -> Column:
    """A plain string without its quotes."""
    return F.substring(raw, F.lit(2), F.length(raw) - 2)


def _value(raw: Column, kind: Column) -> Column:
    """Canonical text of a value; fractions through one double format."""
    return (
        F.when(kind == "number", raw.try_cast("double").cast("string"))
        .when(kind == "integer", raw.try_cast("bigint").cast("string"))
        .when(kind.isin("boolean", "null") | _plain_string(raw, kind), raw)
        .otherwise(F.to_json(F.try_parse_json(raw)))
    )


def _raw_shown(raw: Column, quote: bool, kind: Column) -> Column:
    """``_shown`` of a value's text."""
    text = F.when(_plain_string(raw, kind), _inner(raw)).otherwise(F.try_variant_get(F.try_parse_json(raw), "$", "string"))
    return (
        F.when(kind == "null", "None")
        .when(kind == "boolean", F.initcap(raw))
        .when(kind == "string", F.concat(F.lit("'"), text, F.lit("'")) if quote else text)
        .when(kind == "number", short_float(raw.try_cast("double")))
        .when(kind == "integer", raw.try_cast("bigint").cast("string"))
        .otherwise(text)
    )


def flatten_config(df: DataFrame, key: Sequence[str] | str = "config_id", config: str = "config") -> DataFrame:
    """(key, path, type, value, num): the leaves; lists and empty objects are leaves. ``num`` is
    the value of a number."""
    key = [key] if isinstance(key, str) else list(key)
    return _leaf_rows(df.select(*key, F.explode(_merged(F.col(config))).alias("n")), key)


def _leaf_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    raw, kind = F.col("raw"), F.col("type")
    rows = rows.select(*key, "n.path", "n.raw").withColumn("type", _raw_kind(raw))
    return rows.select(*key, "path", "type", _value(raw, kind).alias("value"), _raw_number(raw, kind).alias("num"))


def _above(path: str, known: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    """The paths a path lies under; those of one parent are worked out once."""
    at = path.rfind(".")
    if at < 0:
        return ()
    up = path[:at]
    if up not in known:
        ends = [i for i, c in enumerate(up) if c == "."]
        known[up] = (*[up[:i] for i in ends], up)
    return known[up]


def _merged_leaves(*texts: str | None) -> list[tuple[str, str]]:
    """(path, value) of the leaves that are left of several layers.

    Every path is looked up in maps of what the last layer is that has it as a leaf, as a leaf that is no object, or as an object with members, so the work is in
    proportion to the leaves and their depth.
    """
    found: list[tuple[int, str, object]] = []
    leaf: dict[str, int] = {}
    closed: dict[str, int] = {}
    inside: dict[str, int] = {}
    known: dict[str, tuple[str, ...]] = {}
    for layer, text in enumerate(texts):
        config = _load(text)
        for path, _, _, _, v in _walk(config) if config is not _BROKEN else ():
            if not path or (isinstance(v, dict) and v):
                continue
            found.append((layer, path, v))
            leaf[path] = layer
            if not isinstance(v, dict):
                closed[path] = layer
            above = _above(path, known)
            # a parent that this layer has marked has its own marked too
            if above and inside.get(above[-1]) != layer:
                inside.update(dict.fromkeys(above, layer))
    # the last layer that closes a parent or one of those above it
    shut = {up: max(closed.get(x, -1) for x in above) for up, above in known.items()} if closed else {}
    left = []
    for layer, path, v in found:
        above = _above(path, known)
        if leaf[path] <= layer and inside.get(path, -1) <= layer and (not above or shut.get(above[-1], -1) <= layer):
            left.append((path, v))
    filled = {up for path, v in left for up in _above(path, known)} if any(isinstance(v, dict) for _, v in left) else set()
    # an empty object next to members of the same object adds nothing
    return [(path, _dump(v)) for path, v in left if not (isinstance(v, dict) and path in filled)]


_merged = _per_row(("path", "raw"), _merged_leaves)


def merge_configs(df: DataFrame, layers: Sequence[str], key: str = "config_id") -> DataFrame:
    """Leaves of the deep merge of several config columns, later columns winning.

    A leaf goes when a later layer holds the same path, a value in place of one of its
    ancestors, or an object in its place. The configs of one row are merged within the row.
    """
    return _leaf_rows(df.select(key, F.explode(_merged(*map(F.col, layers))).alias("n")), [key])


def apply_patch(df: DataFrame, base: str = "base", patch: str = "patch", key: str = "config_id") -> DataFrame:
    """A patch holds the changed keys only; lists are replaced as a whole."""
    return merge_configs(df, [base, patch], key)


# -- differences ------------------------------------------------------------------------


def _diff_text(raw: Column, kind: Column) -> Column:
    num = raw.try_cast("double")
    n = F.json_array_length(raw)
    return (
        F.when(kind == OBJECT, "{...}")
        .when(kind == "array", F.when(n <= 3, _list_text(F.try_parse_json(raw))).otherwise(F.concat(F.lit("["), n.cast("string"), F.lit(" items]"))))
        .when((kind == "number") & ((num < 0.001) | (num > 1000)), F.format_string("%.2e", num))
        .otherwise(_raw_shown(raw, False, kind))
    )


def diff_configs(df: DataFrame, old: str = "old", new: str = "new", key: str = "config_id", loose: bool = False) -> DataFrame:
    """(key, path, line): changes between two config columns. An added or removed subtree is one
    line; an added or removed null is none. ``loose`` compares 1, 1.0 and true as equal."""

    def canon(raw: Column, kind: Column) -> Column:
        if not loose:
            return F.concat(kind, F.lit(":"), _value(raw, kind))
        same = F.when(kind == "boolean", (raw == "true").cast("double")).otherwise(_raw_number(raw, kind))
        return F.coalesce(same.cast("string"), F.concat(kind, F.lit(":"), F.to_json(F.try_parse_json(raw))))

    rows = df.select(key, F.explode(_pairs(F.col(old), F.col(new))).alias("p")).select(key, "p.*")
    for side in "on":
        rows = rows.withColumn(f"{side}_type", F.when(F.col(side).isNotNull(), _raw_kind(F.col(side))))
        raw, kind = F.col(side), F.col(f"{side}_type")
        rows = rows.withColumns({f"{side}_canon": canon(raw, kind), f"{side}_text": _diff_text(raw, kind)})
    added, removed = F.col("o").isNull(), F.col("n").isNull()
    # equal texts are equal values; the canonical ones are only made of texts that differ
    changed = F.when(F.col("o") == F.col("n"), False).otherwise(F.coalesce(F.col("o_canon") != F.col("n_canon"), F.lit(True)))
    empty = (added & (F.col("n_type") == "null")) | (removed & (F.col("o_type") == "null"))
    line = (
        F.when(added, F.format_string("+ %s: %s", "path", "n_text"))
        .when(removed, F.format_string("- %s: %s", "path", "o_text"))
        .otherwise(F.format_string("  %s: %s → %s", "path", "o_text", "n_text"))
    )
    return rows.filter(changed & ~empty).select(key, "path", line.alias("line"))


def _side_by_side(old: str | None, new: str | None) -> list[tuple[str, str | None, str | None]]:
    """(path, old value, new value) of the nodes whose parents are objects in both configs and which are not objects in both themselves."""
    old, new = _load(old), _load(new)
    if old is _BROKEN or new is _BROKEN:
        return []
    a, b = ({path: v for path, _, _, _, v in _walk(config)} for config in (old, new))
    both = {path for path, v in a.items() if isinstance(v, dict) and isinstance(b.get(path), dict)}
    out = []
    for path in [*a, *(p for p in b if p not in a)]:
        up = path.rpartition(".")[0]
        if path and up in both and path not in both:
            out.append((path, _sketch(a[path]) if path in a else None, _sketch(b[path]) if path in b else None))
    return out


_pairs = _per_row(("path", "o", "n"), _side_by_side)


def _hash_of(config: Column) -> Column:
    def line(n: Column) -> Column:
        return F.concat_ws("=", n["path"], _value(n["raw"], _raw_kind(n["raw"])))

    # a config that does not parse has no lines
    lines = F.array_sort(F.transform(_merged(config), line))
    return F.left(F.sha2(F.array_join(lines, "\n"), 256), F.lit(16))


def config_hash(df: DataFrame, key: str = "config_id", config: str = "config") -> DataFrame:
    """(key, config_hash): 16 hex digits over the sorted ``path=value`` lines of a config."""
    return df.select(key, _hash_of(F.col(config)).alias("config_hash"))


def _params(text: str | None, max_depth: int, max_chars: int) -> list[tuple[str, str]]:
    found = _load(text, _python)
    if not isinstance(found, dict):
        return []
    out, todo = [], [("", 0, found)]
    while todo:
        path, depth, v = todo.pop()
        if isinstance(v, dict) and depth <= max_depth:
            todo += [(f"{path}.{_plain(k)}" if path else _plain(k), depth + 1, x) for k, x in v.items()]
        elif path:
            out.append((path, _plain(str(v))[:max_chars]))
    return out


def flatten_params(df: DataFrame, key: str = "config_id", config: str = "config", max_depth: int = 3, max_chars: int = 250) -> DataFrame:
    """(key, name, value): parameters as a tracker logs them, each as Python writes it; objects below ``max_depth`` levels
    of nesting stay whole, in the order of their members."""
    params = _per_row(("name", "value"), lambda text: _params(text, max_depth, max_chars))
    return df.select(key, F.explode(params(F.col(config))).alias("n")).select(key, "n.name", "n.value")


def clean_metric_name(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("."))


# -- validation -------------------------------------------------------------------------

_P = (0.0, 1.0)
# What each config section may hold, as (path, type, constraints).
# Paths under ``[]`` are members of a list; ``req`` lists required members of an object.
TUNING_RULES = (
    ("", "object", {"req": ("optimizer", "scheduler", "batch", "regularization")}),
    ("optimizer", "object", {"req": ("name", "learning_rate")}),
    ("optimizer.name", "string", {"enum": ("adamw", "adam", "sgd", "adafactor")}),
    ("optimizer.learning_rate", "number", {"range": (1e-07, 0.01)}),
    ("optimizer.weight_decay", "number", {"range": (0.0, 0.5)}),
    ("optimizer.betas", "array", {"items": (2, 2)}),
    ("optimizer.betas[]", "number", {"range": _P}),
    ("optimizer.eps", "number", {"range": (1e-10, 0.0001)}),
    ("optimizer.momentum", "number", {"range": _P}),
    ("scheduler", "object", {"req": ("name", "warmup_steps")}),
    ("scheduler.name", "string", {"enum": ("cosine", "linear", "constant", "cosine_with_restarts")}),
    ("scheduler.warmup_steps", "integer", {"range": (0, 1000)}),
    ("scheduler.num_cycles", "integer", {"range": (1, 10)}),
    ("batch", "object", {"req": ("train_batch_size", "eval_batch_size")}),
    ("batch.train_batch_size", "integer", {"enum": (1, 2, 4, 8, 16, 32, 64)}),
    ("batch.eval_batch_size", "integer", {"enum": (1, 2, 4, 8, 16, 32, 64, 128)}),
    ("batch.gradient_accumulation_steps", "integer", {"enum": (1, 2, 4, 8, 16)}),
    ("regularization", "object", {}),
    ("regularization.dropout", "number", {"range": (0.0, 0.5)}),
    ("regularization.attention_dropout", "number", {"range": (0.0, 0.5)}),
    ("regularization.label_smoothing", "number", {"range": (0.0, 0.3)}),
    ("regularization.max_grad_norm", "number", {"range": (0.1, 10.0)}),
    ("lora", "object", {}),
    ("lora.enabled", "boolean", {}),
    ("lora.rank", "integer", {"enum": (4, 8, 16, 32, 64)}),
    ("lora.alpha", "integer", {"enum": (4, 8, 16, 32, 64, 128)}),
    ("lora.target_modules", "array", {"items": (1, 8)}),
    ("lora.target_modules[]", "string", {}),
    ("lora.dropout", "number", {"range": (0.0, 0.5)}),
    ("lora.bias", "string", {"enum": ("none", "all", "lora_only")}),
)
_TEXT, _IMAGE = "pipeline.text_augmentations", "pipeline.image_augmentations"
_ENTRY = {"req": ("name", "enabled", "probability")}
# Fixed values, as above.
AUGMENTATION_RULES = (
    ("", "object", {"req": ("pipeline",)}),
    ("pipeline", "object", {"req": ("enabled",)}),
    ("pipeline.enabled", "boolean", {}),
    (_TEXT, "array", {}),
    (f"{_TEXT}[]", "object", _ENTRY),
    (
        f"{_TEXT}[].name",
        "string",
        {
            "enum": (
                "synonym_replacement",
                "random_insertion",
                "random_deletion",
                "random_swap",
                "back_translation",
                "token_cutoff",
                "contextual_insertion",
            )
        },
    ),
    (f"{_TEXT}[].enabled", "boolean", {}),
    (f"{_TEXT}[].probability", "number", {"range": _P}),
    (f"{_TEXT}[].max_replacements", "integer", {"range": (1, 10)}),
    (f"{_TEXT}[].max_insertions", "integer", {"range": (1, 10)}),
    (f"{_TEXT}[].max_swaps", "integer", {"range": (1, 10)}),
    (f"{_TEXT}[].method", "string", {"enum": ("wordnet", "embedding")}),
    (f"{_TEXT}[].source_lang", "string", {}),
    (f"{_TEXT}[].pivot_lang", "string", {"enum": ("de", "fr", "es", "zh")}),
    (f"{_TEXT}[].cutoff_ratio", "number", {"range": (0.01, 0.5)}),
    (f"{_TEXT}[].model", "string", {}),
    (_IMAGE, "array", {}),
    (f"{_IMAGE}[]", "object", _ENTRY),
    (
        f"{_IMAGE}[].name",
        "string",
        {
            "enum": (
                "random_horizontal_flip",
                "random_crop",
                "color_jitter",
                "random_rotation",
                "random_erasing",
                "cutmix",
                "mixup",
            )
        },
    ),
    (f"{_IMAGE}[].enabled", "boolean", {}),
    (f"{_IMAGE}[].probability", "number", {"range": _P}),
    (f"{_IMAGE}[].padding", "integer", {"range": (0, 32)}),
    (f"{_IMAGE}[].brightness", "number", {"range": _P}),
    (f"{_IMAGE}[].contrast", "number", {"range": _P}),
    (f"{_IMAGE}[].saturation", "number", {"range": _P}),
    (f"{_IMAGE}[].hue", "number", {"range": (0.0, 0.5)}),
    (f"{_IMAGE}[].degrees", "number", {"range": (0, 180)}),
    (f"{_IMAGE}[].scale_min", "number", {"range": (0.01, 0.5)}),
    (f"{_IMAGE}[].scale_max", "number", {"range": (0.1, 1.0)}),
    (f"{_IMAGE}[].alpha", "number", {"range": (0.1, 10.0)}),
    ("pipeline.data_mixing", "object", {}),
    ("pipeline.data_mixing.enabled", "boolean", {}),
    ("pipeline.data_mixing.sources", "array", {"items": (None, 5)}),
    ("pipeline.data_mixing.sources[]", "string", {}),
    ("pipeline.data_mixing.mix_ratio", "number", {"range": (0.0, 0.5)}),
)

_RULE_SCHEMA = (
    "pattern string, want string, low double, high double, low_text string, high_text string, allowed array<string>, "
    "allowed_num array<double>, allowed_text string, min_items int, max_items int, required array<string>, members array<string>"
)


_ANNOTATIONS = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}
_KEYWORDS = {"type", "properties", "required", "enum", "minimum", "maximum", "items", "minItems", "maxItems", "additionalProperties"}
_TYPES = {"object", "array", "string", "number", "integer", "boolean", "null"}


def compile_schema(schema: dict | str) -> tuple:
    """The rules of a JSON Schema, given as a document or its text.

    Raises ``ValueError`` for what is no schema and for keywords that have no rule, so that nothing goes unchecked.
    """
    if isinstance(schema, str):
        schema = json.loads(schema)
    if not isinstance(schema, dict) or not schema:
        raise ValueError("a schema is a non-empty JSON object")
    rules = []

    def walk(path: str, s: dict) -> None:
        if not isinstance(s, dict):
            raise ValueError(f"the schema of '{path}' is no object")
        if unknown := set(s) - _KEYWORDS - _ANNOTATIONS:
            raise ValueError(f"keywords without a rule at '{path}': {sorted(unknown)}")
        kind = s.get("type")
        if kind is not None and kind not in _TYPES:
            raise ValueError(f"unknown type at '{path}': {kind}")
        c: dict = {}
        if "minimum" in s or "maximum" in s:
            c["range"] = (s.get("minimum"), s.get("maximum"))
        if "enum" in s:
            c["enum"] = tuple(s["enum"])
        if "minItems" in s or "maxItems" in s:
            c["items"] = (s.get("minItems"), s.get("maxItems"))
        if s.get("required"):
            c["req"] = tuple(s["required"])
        if s.get("additionalProperties", True) is not False:
            c["open"] = True
        rules.append((path, kind, c))
        for name, member in s.get("properties", {}).items():
            if set(name) & set(".[]"):
                raise ValueError(f"a name that paths can't hold: '{name}'")
            walk(f"{path}.{name}" if path else name, member)
        if "items" in s:
            walk(f"{path}[]", s["items"])

    walk("", schema)
    return tuple(rules)


def rules_table(spark, rules) -> DataFrame:
    """Rules as a table of one row per path; the few members of a schema, by construction."""
    out = []
    for path, kind, c in rules:
        low, high = c.get("range", (None, None))
        enum = c.get("enum")
        strings = [e for e in enum if isinstance(e, str)] if enum else None
        numbers = [float(e) for e in enum if not isinstance(e, str)] if enum else None
        least, most = c.get("items", (None, None))
        prefix = f"{path}." if path else ""
        members = [p[len(prefix):] for p, _, _ in rules if p.startswith(prefix) and p != path and not set(p[len(prefix):]) & set(".[")]
        out.append(
            (
                path, kind, None if low is None else float(low), None if high is None else float(high),
                None if low is None else str(low), None if high is None else str(high),
                strings, numbers, None if enum is None else str(list(enum)), least, most,
                list(c.get("req", ())), members if kind == "object" and not c.get("open") else None,
            )
        )
    return spark.createDataFrame(out, _RULE_SCHEMA)


def validate(df: DataFrame, rules, key: str = "config_id", config: str = "config") -> DataFrame:
    """(key, path, message, violation): every violation of every config; none for a valid one.

    ``rules`` is a JSON Schema (see ``compile_schema``) or a tuple of rules. The rules are a fixed table of some dozens of rows and join the nodes by path pattern;
    every check is then local to a node.
    """
    rules = rules if isinstance(rules, tuple) else compile_schema(rules)
    nodes = df.select(key, F.explode(_unfolded(arrays=True, whole=True)(F.col(config))).alias("n")).select(key, "n.path", "n.pattern", "n.raw")
    r = nodes.join(F.broadcast(rules_table(df.sparkSession, rules)), "pattern").withColumn("type", _raw_kind(F.col("raw")))
    raw, kind, want, num = F.col("raw"), F.col("type"), F.col("want"), F.col("num")
    r = r.withColumn("num", _raw_number(raw, kind))
    whole = (kind == "number") & (num == F.floor(num))
    typed = (kind == want) | ((want == "number") & (kind == "integer")) | ((want == "integer") & whole)
    text = F.when(_plain_string(raw, kind), _inner(raw)).otherwise(F.try_variant_get(F.try_parse_json(raw), "$", "string"))
    listed = F.coalesce(F.when(kind == "string", F.array_contains("allowed", text)), F.lit(False)) | F.coalesce(
        F.array_contains("allowed_num", num), F.lit(False)
    )
    size = F.json_array_length(raw)
    names = F.json_object_keys(raw)
    extra = F.array_except(names, F.col("members"))
    quoted = F.array_join(F.transform(F.array_sort(extra), lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", ")
    say = F.format_string

    def about(condition: Column, rest: Column) -> Column:
        """A message that begins with the value, which is written out below, for violations only."""
        return F.when(condition, F.struct(F.lit(True).alias("shown"), rest.alias("rest")))

    checks = [
        about(~typed, say(" is not of type '%s'", want)),
        about(F.col("allowed_text").isNotNull() & ~listed, say(" is not one of %s", F.col("allowed_text"))),
        about(num < F.col("low"), say(" is less than the minimum of %s", F.col("low_text"))),
        about(num > F.col("high"), say(" is greater than the maximum of %s", F.col("high_text"))),
        about((kind == "array") & (size < F.col("min_items")), F.lit(" is too short")),
        about((kind == "array") & (size > F.col("max_items")), F.lit(" is too long")),
    ]
    more = F.when(
        (kind == OBJECT) & (F.size(extra) > 0),
        say("Additional properties are not allowed (%s %s unexpected)", quoted, F.when(F.size(extra) == 1, "was").otherwise("were")),
    )
    missing = F.when(
        kind == OBJECT,
        F.transform(F.array_except("required", names), lambda k: F.concat(F.lit("'"), k, F.lit("' is a required property"))),
    ).otherwise(F.array().cast("array<string>"))
    complete = F.transform(F.concat(F.array_compact(F.array(more)), missing), lambda t: F.struct(F.lit(False).alias("shown"), t.alias("rest")))
    found = r.select(key, "path", "raw", "type", F.explode(F.concat(F.array_compact(F.array(*checks)), complete)).alias("m"))
    v = F.try_parse_json(raw)
    shown = F.when(kind == "array", _list_text(v)).when(kind == OBJECT, F.to_json(v)).otherwise(_raw_shown(raw, True, kind))
    found = found.select(key, "path", F.when(F.col("m.shown"), F.concat(shown, F.col("m.rest"))).otherwise(F.col("m.rest")).alias("message"))
    where = F.when(F.col("path") == "", "(root)").otherwise(F.replace("path", F.lit("."), F.lit(" → ")))
    return found.withColumn("violation", F.concat(F.lit("["), where, F.lit("] "), F.col("message")))


def accept_proposals(proposals: DataFrame, violations: DataFrame, key: str = "config_id", proposed: str = "proposed", current: str = "current") -> DataFrame:
    """(key, config, accepted): a proposal with violations gives way to the current config."""
    bad = violations.select(key).distinct().withColumn("_bad", F.lit(True))
    out = proposals.join(bad, key, "left")
    ok = F.col("_bad").isNull()
    return out.select(key, F.when(ok, F.col(proposed)).otherwise(F.col(current)).alias("config"), ok.alias("accepted"))


# -- proposals --------------------------------------------------------------------------

# Fixed value: fenced blocks of a response that hold a config.
FENCE = r"(?s)```(?:yaml)?\s*\n(.*?)```"


def proposal_blocks(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pos, block): the fenced blocks of every response, in order."""
    return df.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(FENCE), F.lit(1))).alias("pos", "block"))


def _json_of(members: Column) -> Column:
    return F.concat(
        F.lit("{"), F.array_join(F.transform(members, lambda m: F.concat(F.regexp_replace(F.to_json(F.array(m["k"])), r"^\[|\]$", ""), F.lit(":"), m["v"])), ","), F.lit("}")
    )


def extract_proposals(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, augmentations, tuning): configs proposed in responses, as JSON.

    A block with ``pipeline`` is an augmentation config; one with ``optimizer``, ``scheduler``
    or ``batch`` a tuning config; ``augmentations`` and ``tuning`` wrap one; any other mapping
    adds its keys to the tuning config. Later blocks replace earlier ones. Without a usable
    block the whole response is read. Text that is not YAML is skipped.
    """
    from ..sources.configs import yaml_to_json

    blocks = proposal_blocks(df, key, text).withColumn("_id", F.struct(key, "pos"))
    parsed = yaml_to_json(blocks.select(F.to_json("_id").alias("_id"), "block"), "_id", "block", "doc").filter("doc is not null")
    kind_of_key = dict(df.dtypes)[key]
    parsed = parsed.withColumn("_id", F.from_json("_id", f"`{key}` {kind_of_key}, pos int")).select("_id.*", "doc")
    m = _as_map(F.try_parse_json("doc"))
    has = lambda k: F.map_contains_key(m, k)
    role = (
        F.when(has("pipeline"), "aug")
        .when(has("optimizer") | has("scheduler") | has("batch"), "set")
        .when(has("augmentations"), "wrapped_aug")
        .when(has("tuning"), "wrapped_set")
        .otherwise("add")
    )
    inner = F.when(role == "wrapped_aug", F.get_json_object("doc", "$.augmentations")).when(
        role == "wrapped_set", F.get_json_object("doc", "$.tuning")
    ).otherwise(F.col("doc"))
    routed = parsed.select(key, "pos", F.replace(role, F.lit("wrapped_"), F.lit("")).alias("role"), inner.alias("doc"))
    # read several times below; the YAML is parsed once
    routed = materialize(routed, "proposals")
    last = routed.groupBy(key).agg(
        F.max_by("doc", F.when(F.col("role") == "aug", F.col("pos"))).alias("augmentations"),
        F.max(F.when(F.col("role") == "set", F.col("pos"))).alias("_from"),
    )
    own = routed.filter("role <> 'aug'").join(last.select(key, "_from"), key)
    own = own.filter(F.col("_from").isNull() | (F.col("pos") >= F.col("_from")))
    members = own.select(key, "pos", F.explode(_as_map(F.try_parse_json("doc"))).alias("k", "v"))
    members = members.groupBy(key, "k").agg(F.max_by(F.to_json("v"), "pos").alias("v"))
    tuning = members.groupBy(key).agg(_json_of(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("tuning"))
    found = last.select(key, "augmentations").join(tuning, key, "full")
    some = lambda c: F.when(F.size(_as_map(F.try_parse_json(c))) > 0, F.col(c))
    found = found.select(key, some("augmentations").alias("augmentations"), some("tuning").alias("tuning"))
    found = found.filter(F.col("augmentations").isNotNull() | F.col("tuning").isNotNull())
    found = materialize(found, "proposals")
    rest = yaml_to_json(df.select(key, text).join(found.select(key), key, "left_anti"), key, text, "doc").select(
        key,
        F.get_json_object("doc", "$.augmentations").alias("augmentations"),
        F.get_json_object("doc", "$.tuning").alias("tuning"),
    )
    empty = F.lit("{}")
    return found.unionByName(rest).select(
        key, F.coalesce("augmentations", empty).alias("augmentations"), F.coalesce("tuning", empty).alias("tuning")
    )


# -- mutation ---------------------------------------------------------------------------

# Factors and choices of a random mutation.
EXPLORE_FACTORS = (0.1, 0.3, 0.5, 2.0, 3.0, 10.0)
EXPLOIT_FACTORS = (0.7, 0.8, 0.9, 1.1, 1.2, 1.5)
LEARNING_RATE_BOUNDS = (1e-7, 1e-2)
ENABLED_PROBABILITY = (0.05, 0.3)
BATCH_SIZES, BATCH_CHANCE = (2, 4, 8, 16, 32), 0.3
DROPOUT_RANGE, DROPOUT_CHANCE = (0.0, 0.4), 0.3
LORA_RANKS, LORA_CHANCE = (4, 8, 16, 32), 0.2


def mutate(bases: DataFrame, key: str = "candidate", seed: int = 42, lora: bool = False) -> DataFrame:
    """Random neighbours of configs. Columns: learning_rate, augs (array of name, enabled,
    probability), pipeline_enabled, train_batch_size, dropout, lora_enabled, lora_rank,
    lora_alpha and exploring; wide steps while exploring, small ones after."""
    k = F.col(key)
    d = lambda i: u(seed, "mutate", k, i)
    one_of = lambda draw, xs: F.get(F.array(*[F.lit(x) for x in xs]), pick(draw, len(xs)))
    between = lambda draw, lo, hi: F.round(F.lit(lo) + draw * F.lit(hi - lo), 2)
    low, high = LEARNING_RATE_BOUNDS
    factor = F.when(F.col("exploring"), one_of(d(0), EXPLORE_FACTORS)).otherwise(one_of(d(0), EXPLOIT_FACTORS))
    n = F.size("augs")
    at = pick(d(1), n)
    flipped = F.transform(
        "augs",
        lambda a, i: F.when(
            i == at,
            F.struct(
                a["name"].alias("name"),
                (~a["enabled"]).alias("enabled"),
                F.when(~a["enabled"], between(d(2), *ENABLED_PROBABILITY)).otherwise(a["probability"]).alias("probability"),
            ),
        ).otherwise(a),
    )
    out = bases.withColumn("learning_rate", F.greatest(F.lit(low), F.least(F.lit(high), F.col("learning_rate") * factor)))
    out = out.withColumn("augs", flipped)
    out = out.withColumn(
        "pipeline_enabled", F.when(n > 0, F.exists("augs", lambda a: a["enabled"])).otherwise(F.col("pipeline_enabled"))
    )
    out = out.withColumn(
        "train_batch_size", F.when(d(3) < BATCH_CHANCE, one_of(d(4), BATCH_SIZES)).otherwise(F.col("train_batch_size"))
    )
    out = out.withColumn("dropout", F.when(d(5) < DROPOUT_CHANCE, between(d(6), *DROPOUT_RANGE)).otherwise(F.col("dropout")))
    if lora:
        turn = d(7) < LORA_CHANCE
        out = out.withColumn("lora_enabled", F.when(turn, ~F.col("lora_enabled")).otherwise(F.col("lora_enabled")))
        drawn = turn & F.col("lora_enabled")
        out = out.withColumn("lora_rank", F.when(drawn, one_of(d(8), LORA_RANKS)).otherwise(F.col("lora_rank")))
        out = out.withColumn("lora_alpha", F.when(drawn, F.col("lora_rank") * 2).otherwise(F.col("lora_alpha")))
    return out


def mutate_configs(
    configs: DataFrame, n: int, history: DataFrame | None = None, key: str = "config_id", augmentations: str = "augmentations", tuning: str = "tuning",
    exploring: Column | None = None, seed: int = 42, lora: bool = False,
) -> DataFrame:
    """(key, candidate, augmentations, tuning, config_hash): up to ``n`` random neighbours of every config, as configs.

    Members that a mutation does not touch are kept. Neighbours that are equal, or whose hash ``history`` (a ``config_hash`` column) has, are left out.
    ``candidate`` names a neighbour by the config's key and its number.
    """
    number = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = configs.select(key, F.try_parse_json(tuning).alias("_t"), F.try_parse_json(augmentations).alias("_a"), (F.lit(True) if exploring is None else exploring).alias("exploring"))
    rows = rows.select("*", number.alias("_n")).withColumn("candidate", F.concat_ws("/", F.col(key).cast("string"), "_n"))
    as_map = "map<string,variant>"
    section = lambda v, path: F.coalesce(F.try_variant_get(v, path, as_map), F.create_map().cast(as_map))
    entry = "array<struct<name:string,enabled:boolean,probability:double>>"
    rows = rows.withColumns(
        {
            "learning_rate": F.try_variant_get("_t", "$.optimizer.learning_rate", "double"),
            "augs": F.coalesce(F.try_variant_get("_a", "$.pipeline.text_augmentations", entry), F.array().cast(entry)),
            "pipeline_enabled": F.coalesce(F.try_variant_get("_a", "$.pipeline.enabled", "boolean"), F.lit(False)),
            "train_batch_size": F.try_variant_get("_t", "$.batch.train_batch_size", "int"),
            "dropout": F.try_variant_get("_t", "$.regularization.dropout", "double"),
            "lora_enabled": F.coalesce(F.try_variant_get("_t", "$.lora.enabled", "boolean"), F.lit(False)),
            "lora_rank": F.try_variant_get("_t", "$.lora.rank", "int"),
            "lora_alpha": F.try_variant_get("_t", "$.lora.alpha", "int"),
        }
    )
    m = mutate(rows, "candidate", seed, lora)

    def put(old: Column, **new: Column) -> Column:
        """A section with some members set; members without a value stay away."""
        names = F.array(*[F.lit(k) for k in new])
        kept = F.map_filter(old, lambda k, _: ~F.array_contains(names, k))
        added = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("variant").alias("value")) for k, v in new.items()]), lambda e: e["value"].isNotNull())
        return F.map_concat(kept, F.map_from_entries(added))

    obj = F.to_variant_object
    sections = {
        "optimizer": put(section(F.col("_t"), "$.optimizer"), learning_rate=F.col("learning_rate")),
        "batch": put(section(F.col("_t"), "$.batch"), train_batch_size=F.col("train_batch_size")),
        "regularization": put(section(F.col("_t"), "$.regularization"), dropout=F.col("dropout")),
    }
    if lora:
        sections["lora"] = put(section(F.col("_t"), "$.lora"), enabled=F.col("lora_enabled"), rank=F.col("lora_rank"), alpha=F.col("lora_alpha"))
    new_tuning = F.to_json(put(section(F.col("_t"), "$"), **{k: obj(v) for k, v in sections.items()}))
    members = F.coalesce(F.try_variant_get("_a", "$.pipeline.text_augmentations", f"array<{as_map}>"), F.array().cast(f"array<{as_map}>"))
    entries = F.zip_with(members, "augs", lambda old, a: put(old, name=a["name"], enabled=a["enabled"], probability=a["probability"]))
    pipeline = put(section(F.col("_a"), "$.pipeline"), enabled=F.col("pipeline_enabled"), text_augmentations=F.when(F.size("augs") > 0, obj(entries)))
    out = m.select(key, "candidate", F.to_json(put(section(F.col("_a"), "$"), pipeline=obj(pipeline))).alias(augmentations), new_tuning.alias(tuning))
    both = F.concat(F.lit('{"augmentations":'), F.col(augmentations), F.lit(',"tuning":'), F.col(tuning), F.lit("}"))
    # read several times below; neighbours and their hashes are worked out once, and only keys and hashes are compared
    out = materialize(out.withColumn("config_hash", _hash_of(both)), "neighbours")
    hashes = out.select(key, "candidate", "config_hash")
    first = hashes.groupBy(key, "config_hash").agg(F.min("candidate").alias("candidate"))
    hashes = hashes.join(first, [key, "config_hash", "candidate"], "left_semi")
    if history is not None:
        hashes = hashes.join(history.select("config_hash").distinct(), "config_hash", "left_anti")
    out = out.drop("config_hash").join(hashes.drop(key), "candidate")
    return out.select(key, "candidate", augmentations, tuning, "config_hash")


def grid(bases: DataFrame, space: dict[str, Sequence]) -> DataFrame:
    """Every combination of the listed values for every base config."""
    for name, values in space.items():
        bases = bases.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return bases
