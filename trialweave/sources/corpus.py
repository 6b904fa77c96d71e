"""Text, labelled, image and web sources."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names under which a split may be stored, best first.
SPLIT_ALIASES = {
    "train": ("train",),
    "validation": ("validation", "valid", "dev"),
    "test": ("test",),
}
# Named sets whose text column is not called ``text``.
TEXT_COLUMNS = {"sst2": "sentence"}
IMAGE_SETS = ("cifar10", "cifar100")
MIN_EXTRACT_LENGTH = 50


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One sample per line of the text files under a path."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("text"))


def read_labelled(
    spark: SparkSession, path: str, name: str = "custom", label_col: str = "label", fmt: str = "csv", multi_line: bool = False
) -> DataFrame:
    """(text, label) of a labelled set. Records that contain line breaks need ``multi_line``,
    which reads each file as a whole; without it files are split among tasks."""
    text_col = TEXT_COLUMNS.get(name, "text")
    if fmt == "csv":
        # columns go by the header's names, in any order and among others
        rows = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    else:
        rows = spark.read.format(fmt).load(path)
    return rows.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").try_cast("int").alias("label"))


def resolve_splits(df: DataFrame, split: str = "split") -> DataFrame:
    """Renames split aliases; of several aliases of one split the first listed wins, rows of
    the others and of unknown splits are dropped."""
    choices = F.create_map(
        *[F.lit(x) for target, names in SPLIT_ALIASES.items() for rank, n in enumerate(names) for x in (n, f"{target}:{rank}")]
    )
    named = F.try_element_at(choices, F.col(split))
    present = df.select(F.col(split).alias("_alias"), named.alias("_t")).filter("_t is not null").distinct()
    target = F.split("_t", ":")
    # at most one row per known alias: five rows, whatever the size of the table
    best = present.groupBy(target[0].alias("_split")).agg(F.min_by("_alias", target[1]).alias("_alias"))
    return (
        df.join(F.broadcast(best), df[split] == best["_alias"], "inner")
        .withColumn(split, F.col("_split"))
        .drop("_alias", "_split")
    )


def read_images(spark: SparkSession, path: str, name: str = "custom", fmt: str = "parquet") -> DataFrame:
    """(id, channels, height, width, pixels, label): pixel arrays in channel, row, column order.

    ``fmt='parquet'`` reads stored arrays; ``fmt='image'`` decodes image files, whose label
    is the name of the folder they lie in.
    """
    if name not in ("custom", *IMAGE_SETS):
        raise ValueError(f"Unsupported image dataset: {name}")
    if fmt == "parquet":
        return spark.read.parquet(path).select("id", "channels", "height", "width", "pixels", "label")
    raw = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    rows = raw.select(
        F.col("image.origin").alias("id"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.data").alias("data"),
        F.element_at(F.split("image.origin", "/"), -2).alias("label"),
    )

    def planes(batches: Iterator) -> Iterator:
        import numpy as np

        for pdf in batches:
            arrays = []
            for data, c, h, w in zip(pdf["data"], pdf["channels"], pdf["height"], pdf["width"]):
                a = np.frombuffer(data, dtype=np.uint8).reshape(h, w, c)
                if c == 3:
                    a = a[:, :, ::-1]  # the image source stores blue first
                arrays.append(a.transpose(2, 0, 1).astype("float32").ravel())
            yield pdf.drop(columns="data").assign(pixels=arrays)[["id", "channels", "height", "width", "pixels", "label"]]

    return rows.mapInPandas(planes, "id string, channels int, height int, width int, pixels array<float>, label string")


def pixel_rows(df: DataFrame, key: str, vector: str, height: int, width: int, channels: int = 1, label: str = "label") -> DataFrame:
    """Stored vectors as image rows."""
    return df.select(
        F.col(key).alias("id"),
        F.lit(channels).alias("channels"),
        F.lit(height).alias("height"),
        F.lit(width).alias("width"),
        F.col(vector).alias("pixels"),
        F.col(label).alias("label"),
    )


# -- payloads of web sources ------------------------------------------------------------


def feed_summaries(feed: Column) -> Column:
    """The trimmed summaries of an Atom feed's entries; none for text that is no XML."""
    entries = F.from_xml(feed, "entry array<struct<summary:string>>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"})["entry"]
    said = F.transform(entries, lambda e: F.regexp_replace(e["summary"], r"^\s+|\s+$", ""))
    return F.filter(said, lambda s: s.isNotNull())


# The named entities that texts of pages use, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescaped(text: Column) -> Column:
    for name, letter in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(letter))
    return text


def page_extract(response: Column) -> Column:
    """The first page extract longer than 50 characters in an encyclopedia response, or null."""
    pages = F.from_json(response, "struct<query:struct<pages:map<string,struct<extract:string>>>>")["query"]["pages"]
    texts = F.transform(F.map_values(pages), lambda p: p["extract"])
    return F.get(F.filter(texts, lambda t: F.length(t) > MIN_EXTRACT_LENGTH), F.lit(0))


def extract_payloads(df: DataFrame, key: str, payload: str, kind: str) -> DataFrame:
    """(key, text): the texts contained in raw responses of one kind of source."""
    if kind == "arxiv":
        return df.select(key, F.explode(feed_summaries(F.col(payload))).alias("text"))
    if kind == "wikipedia":
        return df.select(key, page_extract(F.col(payload)).alias("text")).filter("text is not null")
    if kind == "html":
        body = F.regexp_extract_all(F.col(payload), F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
        plain = F.transform(body, lambda p: F.trim(unescaped(F.regexp_replace(p, r"<[^>]*>", " "))))
        return df.select(key, F.array_join(F.filter(plain, lambda p: p != ""), "\n").alias("text")).filter(
            F.length("text") > MIN_EXTRACT_LENGTH
        )
    raise ValueError(f"unknown payload kind: {kind}")
