"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) for every node of a link, from ``a`` and ``b``.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest of them; rounds needed
    grow with the logarithm of the links. Rounds are written to the shared folder, which cuts the lineage. Minima are
    combined before they are shuffled, and only counts and a checksum reach the driver.
    """
    now = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = state
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        now = materialize(small.filter("a <> b").distinct(), "links")
