"""Ordered computations (ranks, running totals, running extremes) without a window that
puts a whole key, or a whole table, into one task.

An order is described by *levels*: columns from coarse to fine that never decrease along
the order (for a timestamp: its day, then its minute). Rows of one finest cell are ordered
by a window of their own. What lies before a cell is found from per-cell totals, which are
aggregated map-side and are small, and enters the cell as one more row at its beginning. A key
holding a third of all rows is therefore spread over all its cells. Cells are pure functions of
the row, so nothing has to be materialised to keep them stable when a task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .session import materialize

_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


def id_levels(col: Column, cell: int = 4096, fanout: int = 4096) -> dict[str, Column]:
    """Levels of a dense integer order; for sparse numbers see ``range_cells``."""
    return {
        "_l0": F.floor(col / F.lit(cell * fanout)).cast("long"),
        "_l1": F.floor(col / F.lit(cell)).cast("long"),
    }


def range_cells(df: DataFrame, order: Sequence[Column], rows: int = 100_000, fanout: int = 1024) -> DataFrame:
    """A stored table with the levels ``_l0`` and ``_l1`` of an order of any kind: hashes, texts, several columns.

    Cells of about ``rows`` rows are cut at bounds that Spark samples from the data; rows of equal order share a cell.
    """
    cells = max(1, -(-df.count() // rows))
    cut = df.repartitionByRange(cells, *order).withColumn("_l1", F.spark_partition_id().cast("long"))
    return materialize(cut.withColumn("_l0", F.floor(F.col("_l1") / F.lit(fanout)).cast("long")), "ordered")


def draw_levels(draw: Column, bits: int = 20) -> dict[str, Column]:
    """Levels of a uniform draw in [0, 1): ``2^bits`` cells of about equal size."""
    return {
        "_l0": F.floor(draw * F.lit(float(2 ** (bits // 2)))).cast("int"),
        "_l1": F.floor(draw * F.lit(float(2**bits))).cast("int"),
    }


def time_levels(ts: Column, unit: str = "minute") -> dict[str, Column]:
    """Levels of a timestamp: day, then minute; seconds for very dense streams."""
    return {"_l0": F.to_date(ts), "_l1": F.date_trunc(unit, ts)}


def _running(
    df: DataFrame, keys: list[str], levels: list[str], order: Sequence[Column], measures: dict[str, tuple[str, str]], last: int
) -> DataFrame:
    """Adds, per measure, the aggregate of a column from the key's first row to ``last`` rows from
    the current one. ``measures`` maps a new name to (column, how)."""
    if levels:
        cells = df.groupBy(*keys, *levels).agg(*[_AGGREGATE[how](c).alias(c) for c, how in measures.values()])
        # what lies before a cell is a running computation over cells, one level coarser
        before = _running(cells, keys, levels[:-1], [F.col(levels[-1])], measures, -1)
        heads = before.select(*keys, *levels, *[F.col(n).alias(c) for n, (c, _) in measures.items()], F.lit(0).alias("_row"))
        df = df.withColumn("_row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
        order = [F.col("_row"), *order]
    w = W.partitionBy(*keys, *levels).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    df = df.withColumns({n: _AGGREGATE[how](c).over(w) for n, (c, how) in measures.items()})
    return df.filter("_row = 1").drop("_row") if levels else df


def _with_levels(df: DataFrame, levels: dict[str, Column] | Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Levels are given as expressions, added for the time being, or as names of columns."""
    if isinstance(levels, dict):
        return df.withColumns(levels), list(levels), list(levels)
    return df, list(levels), []


def number_rows(
    df: DataFrame, keys: Sequence[str], levels: dict[str, Column] | Sequence[str], order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """Exact 1-based position of every row within its key (the whole table if no keys)."""
    df, lv, extra = _with_levels(df, levels)
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return _running(one, list(keys), lv, order, {name: ("_one", "sum")}, 0).drop("_one", *extra)


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    levels: dict[str, Column] | Sequence[str],
    order: Sequence[Column],
    measures: dict[str, tuple[Column, str]],
) -> DataFrame:
    """Adds, per measure, the aggregate of a value over all earlier rows of the key; sums start
    at 0, extremes at null.

    ``measures`` maps a name to (value column, 'sum' | 'min' | 'max').
    """
    df, lv, extra = _with_levels(df, levels)
    df = df.withColumns({f"_v_{n}": v for n, (v, _) in measures.items()})
    out = _running(df, list(keys), lv, order, {n: (f"_v_{n}", how) for n, (_, how) in measures.items()}, -1)
    zero = {n: F.coalesce(n, F.lit(0)) for n, (_, how) in measures.items() if how == "sum"}
    return out.withColumns(zero).drop(*extra, *[f"_v_{n}" for n in measures])


def trailing_rows(df: DataFrame, keys: Sequence[str], seq: str, window: int, exprs: dict, cell: int = 4096) -> DataFrame:
    """Windows over the last ``window`` rows of a key, given the row number ``seq``.

    Every cell of consecutive rows also receives the last ``window - 1`` rows of the cell
    before it, so a frame never has to look outside its cell. ``exprs`` maps a name to a
    function from a WindowSpec to a column.
    """
    cell = max(cell, window)
    own = F.floor(F.col(seq) / F.lit(cell)).cast("long")
    tail = F.pmod(F.col(seq), F.lit(cell)) > F.lit(cell - window)
    copies = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_own", own).withColumn("_cell", F.explode(copies))
    w = W.partitionBy(*keys, "_cell").orderBy(seq).rowsBetween(-(window - 1), 0)
    out = spread.withColumns({n: f(w) for n, f in exprs.items()})
    return out.filter(F.col("_cell") == F.col("_own")).drop("_own", "_cell")
