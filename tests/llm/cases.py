"""Odd rows for the operators on texts."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField("n_chars", T.LongType())]
    # names the operators use themselves
    + [T.StructField(c, T.StringType()) for c in ("_id", "_h", "_text", "node", "cls", "rank", "label")]
)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows():
    rng = random.Random(5)
    long = "\n".join(prose(rng, 30) for _ in range(1500))
    shared = prose(rng, 120)
    base = prose(rng, 60)
    near = base.split()
    near[3] = "changed"
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n \n"),
        (4, long),
        (5, long),
        (6, f"{prose(rng, 20)} {shared} {prose(rng, 20)}"),
        (7, f"{prose(rng, 25)} {shared}"),
        (8, base),
        (9, " ".join(near)),
        (9, " ".join(near)),
        (10, "é" * 700 + "ü"),
        (11, "A a A a\nA a A a\nA a A a\nA a A a\nA a A a"),
        (12, "one two"),
        (13, "ONE two"),
        (None, "one two"),
        (None, None),
        (14, "<|endoftext|> don't \x1c 　x  y\r\n"),
        (15, "z" * 3000),
        (-7, "a b c d e f"),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "s", None, "x", "y", "z", "n", "c", "r", "l") for k, (i, t) in enumerate(texts)]
