"""Number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int) -> Column:
    """``%.<digits>f`` rounded from the exact binary value, ties to even.

    The JVM rounds the shortest decimal text half up instead. The two differ only where that
    text lies exactly between two results, which is found from the exact product
    ``x * 10^(digits + 1)``: the rounded product plus its rounding error.
    """
    scale = float(10 ** (digits + 1))
    split = x * F.lit(134217729.0)  # 2^27 + 1, cuts a double into two halves
    high = split - (split - x)
    low = x - high
    product = x * F.lit(scale)
    whole = F.rint(product)
    error = ((product - whole) + ((high * scale - product) + low * scale)) * F.signum(x)
    size = F.abs(whole)
    close = F.abs(product - whole) <= size * F.lit(2.0**-51)
    halfway = (size < F.lit(9007199254740992.0)) & close & (size % 10 == 5)
    down = halfway & ((error < 0) | ((error == 0) & (F.floor(size / 10) % 2 == 0)))
    return F.format_string(f"%.{digits}f", F.when(down, x * F.lit(1.0 - 2.0**-40)).otherwise(x))


def short_float(x: Column) -> Column:
    """Shortest text of a double as config files show it: ``0.0001``, ``5e-05``, ``1000.0``."""
    s = x.cast("string")
    exponent = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.regexp_extract(s, r"^(.*)E", 1), r"\.0$", "")
    scientific = F.concat(
        mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.lpad(F.abs(exponent).cast("string"), 2, "0")
    )
    plain = F.regexp_replace(x.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]*?)0+$", "$1")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    special = F.when(F.isnan(x), "nan").when(x > 0, "inf").otherwise("-inf")
    return (
        F.when(F.isnan(x) | (F.abs(x) == float("inf")), special)
        .when(exponent.isNull(), s)
        .when((exponent >= -4) & (exponent < 16), plain)
        .otherwise(scientific)
    )
