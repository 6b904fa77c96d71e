"""Word splitting shared by all text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the blanks that separate words (ASCII and Unicode white space).
# Written so that Java's regex engine and RE2 read it alike.
BLANKS = (
    r"[ \t\n\r\f\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)

# The same blanks for Java's engine alone, which tries the members of a class one by one: printable ASCII, as most characters are, is told first.
_SPARK_BLANKS = "(?![!-~])" + BLANKS


def words(text: Column) -> Column:
    """Words of a text; empty strings at the ends are dropped."""
    return F.array_remove(F.split(text, _SPARK_BLANKS), "")


def join_words(ws: Column) -> Column:
    return F.array_join(ws, " ")


def unfolded(items: Column) -> Column:
    """The array to explode, as an expression. When a plain column is exploded, the optimizer
    first filters on its size, and so computes an array made on the way (the words of a text)
    twice, the second time below any repartitioning."""
    return F.concat(items)
