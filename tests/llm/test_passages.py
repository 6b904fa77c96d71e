"""Stretches of lines, passages of words, and the pipeline's stages, against plain versions."""

import random

import brute
import numpy as np
import pytest
from cases import odd_rows, prose

from trialweave.llm import line_dedup, suffix_dedup, word_passages

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def planted(rng):
    """Documents with passages of 51 short words, single long lines and pairs of lines that others have too."""
    short = " ".join(rng.choice("abcdefgh") for _ in range(51))
    half = [prose(rng, 30), prose(rng, 24)]
    line = prose(rng, 60)
    rows = []
    for k in range(12):
        parts = [prose(rng, 40), prose(rng, 35)]
        if k % 3 == 0:
            parts.insert(1, f"{prose(rng, 9)} {short}  {prose(rng, 8)}")
        if k % 4 == 1:
            parts.insert(1, line)
        if k % 4 == 2:
            parts[1:1] = half
        rows.append((100 + k, "\n".join(parts)))
    return rows + [(120, short + " " + short), (121, " ".join(short.split()[1:])), (122, "a " * 300)]


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_long_lines_and_pairs(spark):
    rows = planted(random.Random(2))
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("id", "text").collect()
    want = brute.left_lines(rows)
    assert sorted(map(tuple, got)) == sorted((i, t) for (i, _), t in zip(rows, want))
    assert sum(a != b for (_, a), b in zip(rows, want)) >= 4


@pytest.mark.parametrize("most", [1, 20_000])
def test_word_passages(spark, odd, most):
    rng = random.Random(3)
    few = [rng.choice("abc") for _ in range(3000)]
    rows = planted(rng) + [(200 + k, " ".join(few[a : a + 150]) + "\n" + " \t".join(few[a + 80 : a + 140])) for k, a in enumerate(rng.randint(0, 2800) for _ in range(30))]
    rows += [(r[0], r[1]) for r in odd_rows()]
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), unit=word_passages.Words, most_contexts=most)
    want = brute.left_passages([t for _, t in rows])
    assert sorted(((r["id"], r["text"]) for r in out.collect()), key=str) == sorted(((i, t) for (i, _), t in zip(rows, want)), key=str)


def test_common_prefixes():
    s = np.array([3, 4, 3, 4, 3, 2, 1])
    order = np.array(sorted(range(7), key=lambda k: s[k:].tolist()))
    want = [next((d for d in range(7) if a + d == 7 or b + d == 7 or s[a + d] != s[b + d]), 7) for a, b in zip(order, order[1:])]
    assert word_passages.common_prefixes(s, order, 2).tolist() == [min(x, 2) for x in want]


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline as pipeline

    rng = random.Random(6)
    rows = [(r[0], r[1]) for r in odd_rows() if r[1] and len(r[1]) < 50_000] + planted(rng)
    rows += [(300 + k, prose(rng, rng.randint(20, 200))) for k in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DDL)
    stages = dict(pipeline.STAGES)

    kept = stages["quality"](spark, docs, "")
    good = rows_of(kept)
    assert set(good) <= set(rows) and {i for i, _ in good} >= {300 + k for k in range(60)} - {300}
    lined = stages["lines"](spark, kept, "")
    want = [(i, t) for (i, old), t in zip(good, brute.left_lines(good)) if t == old or brute.words(t)]
    assert rows_of(lined) == sorted(want, key=str)
    one = stages["near_duplicates"](spark, lined, "")
    label = [x[1] for x in brute.components(want)]
    assert {i for i, _ in rows_of(one)} >= set(x for x in label if x is not None)
    assert len(rows_of(one)) == len(set(zip(label, [not brute.words(t) or None for _, t in want])))
    left = rows_of(one)
    cut = stages["passages"](spark, one, "")
    want = [(i, t) for (i, old), t in zip(left, brute.left_passages([t for _, t in left])) if t == old or brute.words(t)]
    assert rows_of(cut) == sorted(want, key=str)
    packed = stages["packing"](spark, cut, "")
    pieces = packed.collect()
    assert {r["doc_id"] for r in pieces} == {i for i, _ in want}
    total = {}
    for r in sorted(pieces, key=lambda r: (str(r["doc_id"]), r["start"])):
        assert total.get(r["doc_id"], 0) == r["start"]
        total[r["doc_id"]] = r["start"] + r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in pieces)
