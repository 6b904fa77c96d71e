"""Keyed draws: every random choice is a pure function of (seed, op, row key, draw number).

A draw does not depend on partitioning, task retries or evaluation order, so a lost
executor recomputes the same rows, and the same formula can be checked in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 4294967296.0  # 2^32


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def u(seed: int, op: str, key: Column, i) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of an md5 over ``seed|op|key|i``."""
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}|{op}"), key.cast("string"), _col(i).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(SPAN)


def gate(seed: int, op: str, key: Column, probability: float) -> Column:
    """True for the share of rows an operator with this probability acts on."""
    return u(seed, f"{op}:gate", key, 0) < F.lit(float(probability))


def pick(draw: Column, n) -> Column:
    """0-based index into a list of n elements."""
    return F.floor(draw * _col(n)).cast("int")


def randint(draw: Column, low, high) -> Column:
    """Integer in [low, high], both ends included."""
    low, high = _col(low), _col(high)
    return (low + F.floor(draw * (high - low + 1))).cast("int")


def uniform(draw: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + draw * F.lit(float(high) - float(low))
