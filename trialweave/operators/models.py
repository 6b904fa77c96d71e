"""Models trained on Spark: count-based language models, nearest centroids, MLlib classifiers,
and the sweep that turns candidate configs into trial results."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import words
from ..plans.ordered import number_rows, range_cells
from ..plans.session import materialize
from .counts import neighbour_counts, word_counts
from .metrics import bits_per_byte, perplexity
from .prepare import exact_split
from .text_augment import TextAugmenter
from .vector_augment import Shape, augment_images

ADD_K = 1.0

# -- count-based language model -----------------------------------------------------------


def _grams(df: DataFrame, text: str, order: int, keep: Sequence[str] = ()) -> DataFrame:
    """One row per word with the word before it ('' when the order is 1)."""
    ws = words(F.lower(F.col(text)))
    if order == 1:
        return df.select(*keep, F.lit("").alias("ctx"), F.explode(ws).alias("tok"))
    rows = df.select(*keep, ws.alias("_w")).filter(F.size("_w") > 1)
    pairs = F.arrays_zip(
        F.slice("_w", F.lit(1), F.size("_w") - 1).alias("ctx"), F.slice("_w", F.lit(2), F.size("_w") - 1).alias("tok")
    )
    return rows.select(*keep, F.explode(pairs).alias("g")).select(*keep, "g.ctx", "g.tok")


@dataclass
class CountLM:
    """Add-k n-gram model: ``grams`` (ctx, tok, c), ``contexts`` (ctx, total), vocabulary size."""

    grams: DataFrame
    contexts: DataFrame
    vocabulary: int
    order: int
    k: float


def train_lm(df: DataFrame, text: str = "text", order: int = 1, k: float = ADD_K) -> CountLM:
    if order not in (1, 2):
        raise ValueError("order must be 1 or 2")
    # the counts are the model: written once, read by everything after
    if order == 1:
        counted = word_counts(df.select(F.lower(F.col(text)).alias("text")), "text", "tok", "c").select(F.lit("").alias("ctx"), "tok", "c")
    else:
        counted = neighbour_counts(df.select(F.lower(F.col(text)).alias("text")), "text", "ctx", "tok", "c")
    grams = materialize(counted, "grams")
    contexts = grams.groupBy("ctx").agg(F.sum("c").alias("total"))
    vocabulary = grams.count() if order == 1 else grams.select("tok").distinct().count()
    return CountLM(grams, contexts, vocabulary, order, k)


def score_lm(model: CountLM, df: DataFrame, text: str = "text", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, tokens, loss, perplexity, bpb). Evaluation words are counted first, so that the
    joins see every distinct word once and no word is hot."""
    keys = list(keys)
    seen = _grams(df, text, model.order, keys).groupBy(*keys, "ctx", "tok").agg(F.count(F.lit(1)).alias("n"))
    if model.order == 1:  # one context: its total is one number
        joined = seen.join(model.grams.drop("ctx"), "tok", "left")
        joined = joined.withColumn("total", model.contexts.agg(F.sum("total")).scalar())
    else:
        # stored, so that its size is known: the grams and contexts of a few texts are found by a scan of the model, without shuffling it
        seen = materialize(seen, "lm-seen")
        grams = model.grams.join(seen.select("ctx", "tok").distinct(), ["ctx", "tok"], "left_semi")
        contexts = model.contexts.join(seen.select("ctx").distinct(), "ctx", "left_semi")
        joined = seen.join(grams, ["ctx", "tok"], "left").join(contexts, "ctx", "left")
    k = F.lit(float(model.k))
    p = (F.coalesce("c", F.lit(0)) + k) / (F.coalesce("total", F.lit(0)) + k * model.vocabulary)
    out = joined.groupBy(*keys).agg(F.sum("n").alias("tokens"), (-F.sum(F.col("n") * F.log(p)) / F.sum("n")).alias("loss"))
    return out.select(*keys, "tokens", "loss", perplexity(F.col("loss")).alias("perplexity"), bits_per_byte(F.col("loss")).alias("bpb"))


def save_lm(model: CountLM, path: str) -> None:
    model.grams.write.parquet(f"{path}/grams")
    model.contexts.write.parquet(f"{path}/contexts")
    facts = [(model.vocabulary, model.order, model.k)]
    model.grams.sparkSession.createDataFrame(facts, "vocabulary bigint, order int, k double").write.parquet(f"{path}/facts")


def load_lm(spark: SparkSession, path: str) -> CountLM:
    f = spark.read.parquet(f"{path}/facts").first()
    return CountLM(spark.read.parquet(f"{path}/grams"), spark.read.parquet(f"{path}/contexts"), f["vocabulary"], f["order"], f["k"])


# -- nearest centroid ---------------------------------------------------------------------

#: Numbers of a block of centroids, which one row holds.
BLOCK_VALUES = 1 << 16


@dataclass
class CentroidModel:
    """``blocks`` (block, many: the labels and centroids of a block, labels ascending) and how many there are."""

    blocks: DataFrame
    count: int


def train_centroids(df: DataFrame, pixels: str = "pixels", label: str = "label") -> CentroidModel:
    """One centroid per class, as a stored table. Sums are partial per task, and no class is brought to the driver."""
    cells = df.select(F.col(label).alias("label"), F.posexplode(pixels).alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    each = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("c"))
    each = materialize(each, "centroids")
    size = each.agg(F.coalesce(F.max(F.size("c")), F.lit(1))).first()[0]
    per_block = max(1, BLOCK_VALUES // size)
    placed = number_rows(range_cells(each, [F.col("label")]), [], ["_l0", "_l1"], [F.col("label")], "n")
    block = F.floor((F.col("n") - 1) / F.lit(per_block)).cast("int")
    blocks = placed.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("many"))
    blocks = materialize(blocks, "centroid-blocks")
    return CentroidModel(blocks, blocks.count())


def centroid_logits(many: Column, pixels: Column) -> Column:
    """array<struct<label, logit>>: minus the squared distance to each of some centroids."""

    def logit(m: Column) -> Column:
        gaps = F.zip_with(m["c"], pixels, lambda a, b: (a - b.cast("double")) * (a - b.cast("double")))
        return F.struct(m["label"].alias("label"), (-F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)).alias("logit"))

    return F.transform(many, logit)


def predict_centroids(df: DataFrame, model: CentroidModel, key: str = "id", pixels: str = "pixels", keep: Sequence[str] = (), salts: int | None = None) -> DataFrame:
    """(key, keep, prediction, probability): the nearest centroid, first label of equals, and its softmax probability.

    Rows meet the centroids block by block, a block being one bounded row; what is left of a row's block is its best logit, the label and the sum of
    exponents. Blocks are joined by number and salt: Spark broadcasts them if they are small, and shuffles rows and blocks alike if not. ``key`` names a row.
    """
    salts = salts or df.sparkSession.sparkContext.defaultParallelism
    blocks = model.blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    numbers = F.sequence(F.lit(0), F.lit(max(model.count, 1) - 1))
    kept = [F.struct(*keep).alias("_keep")] if keep else []
    rows = df.select(key, *kept, F.col(pixels).alias("_x"), F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("_salt"), F.explode(numbers).alias("block"))
    kept = ["_keep"] if keep else []
    met = rows.join(blocks, ["block", "_salt"]).select(key, *kept, "block", centroid_logits(F.col("many"), F.col("_x")).alias("logits"))
    best = met.select(key, *kept, "block", predict_top(F.col("logits")).alias("t"))
    top = F.max(F.struct(F.col("t.logit").alias("logit"), (-F.col("block")).alias("_b"), F.col("t.label").alias("label"), *kept))
    out = best.groupBy(key).agg(top.alias("b"), F.collect_list("t").alias("all"))
    total = F.aggregate("all", F.lit(0.0), lambda acc, t: acc + t["total"] * F.exp(t["logit"] - F.col("b.logit")))
    return out.select(key, *[F.col(f"b._keep.{c}").alias(c) for c in keep], F.col("b.label").alias("prediction"), (1 / total).alias("probability"))


def predict_top(logits: Column) -> Column:
    """struct<logit, label, total>: the largest logit, its first label, and the sum of exponents against it."""
    top = F.array_max(F.transform(logits, lambda s: s["logit"]))
    first = F.get(F.filter(logits, lambda s: s["logit"] == top), F.lit(0))
    total = F.aggregate(logits, F.lit(0.0), lambda a, s: a + F.exp(s["logit"] - top))
    return F.struct(top.alias("logit"), first["label"].alias("label"), total.alias("total"))


def save_centroids(model: CentroidModel, path: str) -> None:
    model.blocks.write.parquet(f"{path}/centroids")


def load_centroids(spark: SparkSession, path: str) -> CentroidModel:
    blocks = spark.read.parquet(f"{path}/centroids")
    return CentroidModel(blocks, blocks.count())


def predict(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Adds ``prediction`` (arg-max, first of equals) and ``probability`` (max softmax)."""
    df = df.withColumn("_v", F.transform(logits, lambda s: s["logit"])).withColumn("_top", F.array_max("_v"))
    total = F.aggregate("_v", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("_top")))
    first = F.filter(logits, lambda s: s["logit"] == F.col("_top"))
    out = df.withColumn("prediction", F.get(first, F.lit(0))["label"]).withColumn("probability", 1 / total)
    return out.drop("_v", "_top")


def train_image_classifier(df: DataFrame, shape: Shape, key: str = "id", config: dict | None = None, seed: int = 42) -> tuple[CentroidModel, DataFrame]:
    """Splits, augments the training part, fits centroids; returns them with the scored
    validation rows."""
    rows = exact_split(df, key, seed=seed, approx=True)
    train, _ = augment_images(rows.filter("split = 'train'"), config or {}, shape, key=key, seed=seed)
    model = train_centroids(train)
    held = rows.filter("split = 'validation'")
    return model, predict_centroids(held, model, key, keep=["label"])


# -- MLlib text classifier ----------------------------------------------------------------


def train_text_classifier(
    df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", config: dict | None = None, seed: int = 42,
    features: int = 1 << 14, max_iter: int = 20, **tables,
):
    """(model, predictions, metrics): logistic regression on hashed words. Augmentation acts on
    the training split only; loss and accuracy are taken on the validation split. A column ``split``
    of the data is kept to; without one the rows are split here."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF

    rows = df if "split" in df.columns else exact_split(df, key, seed=seed, approx=True)
    train = TextAugmenter(config or {}, key=key, text=text, seed=seed, **tables).apply(rows.filter("split = 'train'"))
    prepare = lambda x: x.select(key, F.col(label).cast("double").alias("label"), words(F.lower(F.col(text))).alias("words"))
    stages = [
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
        LogisticRegression(maxIter=max_iter, regParam=0.01, family="multinomial"),
    ]
    model = Pipeline(stages=stages).fit(prepare(train))
    scored = model.transform(prepare(rows.filter("split = 'validation'")))
    from pyspark.ml.functions import vector_to_array

    p = F.get(vector_to_array("probability"), F.col("label").cast("int"))
    scored = scored.select(key, "label", "prediction", (-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"))
    metrics = scored.agg(
        F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("samples"),
    )
    return model, scored, metrics


def save_classifier(model, path: str) -> None:
    model.write().save(path)


def load_classifier(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def load_model(spark: SparkSession, path: str):
    """Whichever kind of model lies under a path: a fitted MLlib model, which has metadata, a centroid model or a count model."""

    def there(name: str) -> bool:
        part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        return part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(part)

    if there("metadata"):
        return load_classifier(path)
    return load_centroids(spark, path) if there("centroids") else load_lm(spark, path)


# -- sweeps -------------------------------------------------------------------------------


def trial_sweep(
    train: DataFrame, validation: DataFrame, candidates: Sequence[dict] | DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42,
    k: float = ADD_K, **tables,
) -> DataFrame:
    """One result row per candidate: (trial_id, train_tokens, vocabulary, loss).

    ``candidates``: configs, numbered from 0, or a table (trial_id, config as JSON), whose rows become expressions of the plan.

    The training texts are read once, whatever the number of candidates. A row passes through all of them, and only where a candidate changes its text
    are the words before and after counted for that candidate, as -1 and +1; the words of all texts are counted once for all. A candidate is thus what differs from
    the unchanged corpus: its sums are corrections to the corpus' own, and neither texts nor vocabulary are multiplied by candidates.
    Candidates that look words up are joined in the same pass.
    """
    if isinstance(candidates, DataFrame):
        listed = [(r["trial_id"], json.loads(r["config"])) for r in candidates.select("trial_id", "config").orderBy("trial_id").collect()]
    else:
        listed = list(enumerate(candidates))
    spark = train.sparkSession
    rows = train.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    acting = []
    for i, config in listed:
        augmenter = TextAugmenter(config, key="_key", text=f"_text{i}", seed=seed, **tables)
        if len(augmenter):
            rows = augmenter.apply(rows.withColumn(f"_text{i}", F.col("_text")))
            acting.append(i)

    def part(trial: Column, sign: int, value: Column) -> Column:
        return F.struct(trial.cast("bigint").alias("trial_id"), F.lit(sign).alias("sign"), value.alias("text"))

    changes = [F.when(F.col(f"_text{i}") != F.col("_text"), F.array(part(F.lit(i), 1, F.col(f"_text{i}")), part(F.lit(i), -1, F.col("_text")))) for i in acting]
    parts = F.array(F.array(part(F.lit(None), 1, F.col("_text"))), *changes)
    each = rows.select(F.explode(F.flatten(F.array_compact(parts))).alias("p")).select("p.*")
    lowered = each.withColumn("text", F.lower("text"))
    counts = materialize(word_counts(lowered, "text", "tok", "c", by="trial_id", weight="sign"), "sweep-counts")

    seen = materialize(_grams(validation, text, 1).groupBy("tok").agg(F.count(F.lit(1)).alias("n")), "sweep-validation")
    base = counts.filter("trial_id IS NULL").select("tok", F.col("c").alias("base")).join(seen, "tok", "left")
    k_ = F.lit(float(k))
    whole = base.agg(
        F.coalesce(F.sum("base"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words"),
        F.coalesce(F.sum(F.col("n") * (F.log(F.col("base") + k_) - F.log(k_))), F.lit(0.0)).alias("gain"),
    )
    changed = counts.filter("trial_id IS NOT NULL AND c <> 0").join(base.drop("n"), "tok", "left").join(seen, "tok", "left")
    was = F.coalesce("base", F.lit(0))
    now = was + F.col("c")
    moved = changed.groupBy("trial_id").agg(
        F.sum("c").alias("d_tokens"),
        F.sum(F.when(was == 0, 1).when(now == 0, -1).otherwise(0)).alias("d_words"),
        F.sum(F.col("n") * (F.log(now + k_) - F.log(was + k_))).alias("d_gain"),
    )
    trials = spark.createDataFrame([(i,) for i, _ in listed], "trial_id bigint").join(moved, "trial_id", "left")
    one = whole.first()  # three numbers of the corpus
    total = seen.agg(F.sum("n")).first()[0]
    tokens = F.lit(one["tokens"]) + F.coalesce("d_tokens", F.lit(0))
    vocabulary = F.lit(one["words"]) + F.coalesce("d_words", F.lit(0))
    gain = F.lit(one["gain"]) + F.coalesce("d_gain", F.lit(0.0))
    mean = F.try_divide(gain, F.lit(total)) + F.log(k_) - F.log(tokens + k_ * vocabulary)
    return trials.select("trial_id", tokens.cast("bigint").alias("train_tokens"), vocabulary.cast("bigint").alias("vocabulary"), (-mean).alias("loss"))


def classifier_sweep(df: DataFrame, candidates: Sequence[dict], parallel: int = 4, **options) -> DataFrame:
    """(trial_id, loss, accuracy, samples): one text classifier per candidate config.

    A few candidates train at a time, each by Spark jobs of its own; with the FAIR scheduler
    they share the cluster evenly. Only the three numbers of a trial reach the driver.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    spark = df.sparkSession

    @inheritable_thread_target(spark)
    def run(trial: tuple[int, dict]) -> tuple:
        number, config = trial
        _, _, metrics = train_text_classifier(df, config=config, **options)
        m = metrics.first()
        return number, m["loss"], m["accuracy"], m["samples"]

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(run, enumerate(candidates)))
    return spark.createDataFrame(rows, "trial_id bigint, loss double, accuracy double, samples bigint")


def baseline_trial(train: DataFrame, validation: DataFrame, text: str = "text", config: str = "{}") -> DataFrame:
    """The model without augmentation as a trials row with trial id -1."""
    scores = score_lm(train_lm(train, text), validation, text)
    return scores.select(
        F.lit(-1).cast("bigint").alias("trial_id"),
        F.lit("baseline").alias("decision"),
        F.col("loss").alias("primary_metric"),
        F.to_json(F.struct("loss", "perplexity", "bpb")).alias("metrics_json"),
        F.lit(config).alias("tuning_json"),
        "tokens",
    )
