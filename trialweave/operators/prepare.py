"""Preparation of samples: tokens, vocabulary, packing, splits, batches, pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import u
from ..functions.texts import words
from ..plans.lookup import chunk_lookup
from ..plans.ordered import draw_levels, number_rows, range_cells, running_before
from ..plans.session import materialize
from . import counts as task_counts

# Reserved tokens come first in every vocabulary; padding has id 0.
SPECIALS = ("<pad>", "<unk>")
IGNORE_LABEL = -100


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens", lower: bool = False) -> DataFrame:
    source = F.lower(F.col(text)) if lower else F.col(text)
    return df.withColumn(out, words(source))


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(tok, cnt), counted per task before rows are shuffled."""
    return task_counts.token_counts(df, tokens, "tok", "cnt")


def rank_tokens(counts: DataFrame) -> DataFrame:
    """Adds the 0-based rank by (count descending, token), within cells whose bounds follow the data, so neither the long
    tail of rare tokens nor tokens of one beginning are one task."""
    order = [F.col("cnt").desc(), F.col("tok")]
    # stored, as cells are cut in several passes, each of which would count the corpus anew
    ranked = number_rows(range_cells(materialize(counts, "token-counts"), order), [], ["_l0", "_l1"], order, "rank")
    return ranked.withColumn("rank", F.col("rank") - 1).drop("_l0", "_l1")


def build_vocab(
    df: DataFrame, tokens: str = "tokens", max_size: int | None = None, min_count: int = 1,
    specials: Sequence[str] = SPECIALS,
) -> DataFrame:
    """(tok, cnt, id): ids follow the reserved tokens by descending count. ``max_size`` keeps the commonest only."""
    ranked = rank_tokens(token_counts(df, tokens).filter(F.col("cnt") >= min_count))
    if max_size is not None:
        ranked = ranked.filter(F.col("rank") < max_size)
    return ranked.select("tok", "cnt", (F.col("rank") + len(specials)).cast("int").alias("id"))


def encode(df: DataFrame, vocab: DataFrame, key: str = "doc_id", tokens: str = "tokens", unk: int = 1) -> DataFrame:
    """(key, input_ids); a text without tokens has no ids. The distinct tokens of chunks of texts look their ids up, see ``chunk_lookup``."""
    rows = df.select(key, F.col(tokens).alias("_tokens"))
    ids = vocab.select("tok", F.col("id").cast("int").alias("value"))
    found = chunk_lookup(rows, key, "_tokens", lambda asked: asked.join(ids, "tok"), "_ids", T.IntegerType(), keep=False, missing=unk)
    return found.select(key, F.coalesce("_ids", F.array().cast("array<int>")).alias("input_ids"))


def truncate_pad(
    df: DataFrame, max_length: int, ids: str = "input_ids", pad_id: int = 0, special_ids: Sequence[int] = (0, 1)
) -> DataFrame:
    """Fixed-length ids with their attention and special-token masks."""
    real = F.least(F.size(ids), F.lit(max_length))
    cut = F.slice(F.col(ids), 1, max_length)
    padded = F.concat(cut, F.array_repeat(F.lit(pad_id), (F.lit(max_length) - real).cast("int")))
    mask = F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), (F.lit(max_length) - real).cast("int")))
    return (
        df.withColumn("attention_mask", mask)
        .withColumn(ids, padded)
        .withColumn("special_tokens_mask", F.transform(F.col(ids), lambda x: x.isin(*special_ids).cast("int")))
    )


def pack_sequences(
    df: DataFrame, max_length: int, key: str = "doc_id", ids: str = "input_ids", prepad: bool = False, cell: int = 100_000
) -> DataFrame:
    """(block_id, input_ids): token streams joined in the order of their keys, which are unique and of any type, and cut into exact
    blocks; the remainder is dropped. Only keys and lengths enter the running offset, which then joins the tokens; a row is
    cut into its pieces, and a block gathers at most ``max_length`` tokens."""
    if prepad:
        df = truncate_pad(df, max_length, ids)
    L = F.lit(max_length)
    rows = df.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"), F.size(ids).cast("long").alias("_len")).filter(
        F.col("_len") > 0
    )
    lengths = range_cells(rows.select("_key", "_len"), [F.col("_key")], cell)
    offsets = running_before(lengths, [], ["_l0", "_l1"], [F.col("_key")], {"_off": (F.col("_len"), "sum")})
    rows = rows.join(offsets.select("_key", "_off"), "_key")
    first, last = F.floor(F.col("_off") / L), F.floor((F.col("_off") + F.col("_len") - 1) / L)
    pieces = rows.select("_ids", "_off", "_len", F.explode(F.sequence(first, last)).alias("block_id"))
    start = F.greatest(F.col("block_id") * L, F.col("_off"))
    end = F.least((F.col("block_id") + 1) * L, F.col("_off") + F.col("_len"))
    pieces = pieces.select(
        F.col("block_id").cast("long"),
        F.struct(
            start.alias("at"),
            F.slice("_ids", (start - F.col("_off") + 1).cast("int"), (end - start).cast("int")).alias("ids"),
        ).alias("p"),
    )
    blocks = pieces.groupBy("block_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["ids"])).alias("input_ids")
    )
    return blocks.filter(F.size("input_ids") == max_length)


def lm_labels(df: DataFrame, ids: str = "input_ids", mask_pads: bool = False, pad_id: int = 0) -> DataFrame:
    labels = F.transform(F.col(ids), lambda x: F.when(x == pad_id, IGNORE_LABEL).otherwise(x)) if mask_pads else F.col(ids)
    return df.withColumn("labels", labels)


# -- splits and batches -----------------------------------------------------------------


def _shuffled_rank(df: DataFrame, key: str, seed: int, tag: str, name: str) -> DataFrame:
    df = df.withColumn("_u", u(seed, tag, F.col(key), 0))
    return number_rows(df, [], draw_levels(F.col("_u")), [F.col("_u"), F.col(key)], name).drop("_u")


def exact_split(df: DataFrame, key: str, train: float = 0.9, seed: int = 42, tag: str = "split", approx: bool = False) -> DataFrame:
    """Adds ``split``: exactly ``int(train * n)`` rows of a random permutation are 'train', the
    others 'validation'. ``approx`` decides per row alone, without counting."""
    if approx:
        inside = u(seed, tag, F.col(key), 0) < F.lit(train)
        return df.withColumn("split", F.when(inside, "train").otherwise("validation"))
    keep = int(train * df.count())
    ranked = _shuffled_rank(df.select(key), key, seed, tag, "_rank")
    split = F.when(F.col("_rank") <= keep, "train").otherwise("validation")
    return df.join(ranked.select(key, split.alias("split")), key)


def assign_batches(
    df: DataFrame, key: str, size: int = 8, shuffle: bool = True, drop_last: bool = True, seed: int = 42, tag: str = "batch"
) -> DataFrame:
    """Adds ``batch_id``. Training order is a random permutation without the short last batch,
    evaluation order is the key order with it."""
    keys = df.select(key)
    ranked = (
        _shuffled_rank(keys, key, seed, tag, "_rank")
        if shuffle
        else number_rows(range_cells(keys, [F.col(key)]), [], ["_l0", "_l1"], [F.col(key)], "_rank")
    )
    if drop_last:
        n = df.count()
        ranked = ranked.filter(F.col("_rank") <= n - n % size)
    batch = F.floor((F.col("_rank") - 1) / F.lit(size)).cast("long")
    return df.join(ranked.select(key, batch.alias("batch_id")), key)


# -- pixels: ARRAY<FLOAT> in channel, row, column order ---------------------------------

# Channel statistics images are standardised with.
CHANNEL_MEAN = (0.4914, 0.4822, 0.4465)
CHANNEL_STD = (0.2470, 0.2435, 0.2616)


def resize(df: DataFrame, size: int, height: int, width: int, channels: int = 1, pixels: str = "pixels", method: str = "nearest") -> DataFrame:
    """Square resize by nearest neighbour or bilinear interpolation (pixel centres aligned)."""
    p = F.col(pixels)
    plane = height * width

    def at(c, y, x):
        return F.get(p, (c * plane + y * width + x).cast("int"))

    def value(i: Column) -> Column:
        c = F.floor(i / F.lit(size * size))
        y = F.floor((i % (size * size)) / F.lit(size))
        x = i % size
        if method == "nearest":
            return at(c, F.floor((y * height) / F.lit(size)), F.floor((x * width) / F.lit(size)))
        fy = F.greatest(F.lit(0.0), (y + 0.5) * (height / size) - 0.5)
        fx = F.greatest(F.lit(0.0), (x + 0.5) * (width / size) - 0.5)
        y0, x0 = F.floor(fy), F.floor(fx)
        y1, x1 = F.least(y0 + 1, F.lit(height - 1)), F.least(x0 + 1, F.lit(width - 1))
        top = at(c, y0, x0) * (1 - (fx - x0)) + at(c, y0, x1) * (fx - x0)
        low = at(c, y1, x0) * (1 - (fx - x0)) + at(c, y1, x1) * (fx - x0)
        return top * (1 - (fy - y0)) + low * (fy - y0)

    n = channels * size * size
    return df.withColumn(pixels, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), value))


def standardize_channels(
    df: DataFrame, plane: int, pixels: str = "pixels", mean: Sequence[float] = CHANNEL_MEAN, std: Sequence[float] = CHANNEL_STD,
    scale: float = 1.0,
) -> DataFrame:
    """(x / scale - mean[c]) / std[c] for every pixel; ``scale`` is 255 for byte pixels."""
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])

    def value(x: Column, i: Column) -> Column:
        c = F.floor(i / F.lit(plane)).cast("int")
        return (x.cast("double") / F.lit(float(scale)) - F.get(m, c)) / F.get(s, c)

    return df.withColumn(pixels, F.transform(F.col(pixels), value))


def _encoded(df: DataFrame, options: dict) -> DataFrame:
    tokens = tokenize(df, options.get("text", "text"))
    vocab = options.get("vocab")
    if vocab is None:
        vocab = materialize(build_vocab(tokens, max_size=options.get("vocab_size")), "vocab")
    return encode(tokens, vocab, options.get("key", "doc_id"))


def prepare(task: str, df: DataFrame, **options) -> DataFrame:
    """Chooses the preparation for a task. Without a ``vocab`` one is built, of the ``vocab_size`` commonest tokens if that is given."""
    key = options.get("key", "doc_id")
    if task == "language_modeling":
        # packing reads the rows twice, for their lengths and for their tokens
        encoded = materialize(_encoded(df, options), "encoded")
        return lm_labels(pack_sequences(encoded, options.get("max_length", 512), key, prepad=options.get("prepad", False)))
    if task == "text_classification":
        encoded = truncate_pad(_encoded(df, options), options.get("max_length", 128))
        return encoded.join(df.select(key, F.col(options.get("label", "label")).alias("labels")), key)
    if task == "image_classification":
        h, w, c, size = options["height"], options["width"], options["channels"], options.get("image_size", 32)
        resized = resize(df, size, h, w, c, method=options.get("method", "bilinear"))
        return standardize_channels(
            resized, size * size, mean=options.get("mean", CHANNEL_MEAN), std=options.get("std", CHANNEL_STD),
            scale=options.get("scale", 255.0),
        )
    raise ValueError(f"Unknown task: {task}")
