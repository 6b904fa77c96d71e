"""Mixing external texts into a corpus."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import u
from ..plans.ordered import draw_levels, number_rows
from .safety import pii_findings

log = logging.getLogger(__name__)

MAX_SOURCES = 5
MAX_RATIO = 0.5


def fetch_union(available: dict[str, DataFrame], sources: Sequence[str], max_results: int = 50, key: str = "id", text: str = "text") -> DataFrame:
    """(source, key, text): the sources in listed order, each capped, and the whole capped
    again. Unknown sources are skipped with a warning."""
    parts = []
    for pos, name in enumerate(sources):
        if name not in available:
            log.warning("unknown source: %s", name)
            continue
        top = available[name].select(key, text).orderBy(key).limit(max_results)
        parts.append(top.select(F.lit(pos).alias("_pos"), F.lit(name).alias("source"), key, text))
    if not parts:
        raise ValueError("no known source")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("_pos", key).limit(max_results).drop("_pos")


def mix_external(
    base: DataFrame, external: Sequence[DataFrame], mix_ratio: float = 0.1, key: str = "id", text: str = "text",
    seed: int = 42, scan: bool = True,
) -> DataFrame:
    """Adds ``floor(mix_ratio * n_base)`` external rows, those with the lowest draws, to the base.
    ``origin`` tells them apart; with ``scan`` an external row carries its ``pii_count``."""
    if not 0.0 <= mix_ratio <= MAX_RATIO:
        raise ValueError(f"mix_ratio must be within [0, {MAX_RATIO}]")
    if len(external) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} sources")
    none = F.lit(None).cast("bigint")
    own = base.select(key, text, F.lit("base").alias("origin"), none.alias("pii_count"))
    take = int(mix_ratio * base.count())
    if take == 0 or not external:
        return own
    rows = None
    for i, e in enumerate(external):
        part = e.select(key, text, F.lit(f"external{i}").alias("origin"))
        rows = part if rows is None else rows.unionByName(part)
    draw = u(seed, "mix", F.concat_ws(":", F.col("origin"), F.col(key).cast("string")), 0)
    ids = rows.select(key, "origin").withColumn("_u", draw)
    ranked = number_rows(ids, [], draw_levels(F.col("_u")), [F.col("_u"), F.col("origin"), F.col(key)], "_rank")
    kept = rows.join(ranked.filter(F.col("_rank") <= take).select(key, "origin"), [key, "origin"])
    count = F.size(pii_findings(F.col(text))).cast("bigint") if scan else none
    return own.unionByName(kept.select(key, text, "origin", count.alias("pii_count")))
