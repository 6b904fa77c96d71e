"""Operators on texts against plain versions, on a table of odd rows: nulls, blanks, long texts, repeated rows, clashing names."""

import collections
import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
import regex
from cases import prose
from pyspark.sql import functions as F

from trialweave.llm import byte_bpe, jaccard_join, line_dedup, neighbour_quality, packing, quality_rules, suffix_dedup, suffix_tree_lm
from trialweave.llm.suffix_sort import suffix_array


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def test_line_dedup(odd, texts):
    got = line_dedup.line_dedup(odd, keep=["lang"]).select("id", "text").collect()
    want = [(i, t) for (i, _), t in zip(texts, brute.left_lines(texts))]
    assert sorted_rows(got) == sorted_rows(want)


def test_line_dedup_many_copies(spark):
    rng = random.Random(2)
    block = [prose(rng, 5) for _ in range(6)]
    rows = [(k, "\n".join([prose(rng, 4)] * (k % 3) + block[k % 4 :] + [prose(rng, 4)])) for k in range(60)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("id", "text").collect()
    assert sorted_rows(got) == sorted_rows([(i, t) for (i, _), t in zip(rows, brute.left_lines(rows))])


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 4, 30])) for _ in range(rng.randint(0, 30))]
        s = s * rng.choice([1, 1, 3]) + [0]
        assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def cut_rows(out):
    return sorted_rows(out.select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_suffix_dedup(odd, texts):
    want = [(i, *x) for (i, _), x in zip(texts, brute.removed_strings([t for _, t in texts]))]
    assert cut_rows(suffix_dedup.suffix_dedup(odd)) == sorted_rows(want)


@pytest.mark.parametrize("most", [20_000, 3])
def test_suffix_dedup_near_copies(spark, most):
    """Copies with edits, passages between other words, periodic texts; also by the way of anchors with very many contexts."""
    rng = random.Random(3)
    base, passage = prose(rng, 300), prose(rng, 150)
    rows = []
    for k in range(40):
        w = base.split()
        for _ in range(3):
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows += [(3 * k, " ".join(w)), (3 * k + 1, f"{prose(rng, 60)} {passage} {prose(rng, 60)}"), (3 * k + 2, "ab" * rng.randint(100, 500))]
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), most_contexts=most)
    assert cut_rows(out) == sorted_rows([(i, *x) for (i, _), x in zip(rows, brute.removed_strings([t for _, t in rows]))])


def test_long_texts_are_hashed_in_pieces():
    rng = random.Random(9)
    text = prose(rng, 400_000).encode()
    assert len(text) > 2 * suffix_dedup.PIECE
    found = list(suffix_dedup.spots([text, text[1000:3000]], suffix_dedup.Hasher(suffix_dedup.PIECE + 800)))
    starts = sorted((t, s) for t, _, _, a, b, _ in found for s in range(a, b + 1))
    assert starts == [(0, s) for s in range(len(text) - 399)] + [(1, s) for s in range(1601)]


def test_jaccard(odd, texts):
    got = jaccard_join.similar_components(odd).select("id", "n_shingles", "component").collect()
    assert sorted_rows(got) == sorted_rows([(i, *x) for (i, _), x in zip(texts, brute.components(texts))])


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_jaccard_near_copies(spark, block):
    """Chains of copies with edits; also in groups that are dealt over blocks."""
    rng = random.Random(4)
    rows = []
    for k in range(150):
        if k % 25 == 0:
            w = prose(rng, 80).split()
        w = list(w)
        w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((k, " ".join(w)))
        if k % 10 == 0:
            rows.append((1000 + k, " ".join(w[:40]) + " " + prose(rng, 40)))
    out = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    got = out.select("id", "n_shingles", "component").collect()
    assert sorted_rows(got) == sorted_rows([(i, *x) for (i, _), x in zip(rows, brute.components(rows))])


def test_leftover_classes_meet_all_blocks(spark):
    """Two families that share one group but not the leader's component, over several blocks."""
    rng = random.Random(8)
    sets = []
    a = rng.sample(range(10_000), 100)
    for family in (a, a[:20] + rng.sample(range(10_000, 20_000), 80)):
        for k in range(30):
            own = list(family)
            own[50 + k] = 50_000 + len(sets)
            sets.append(np.array(sorted(own)))
    links = jaccard_join.link_group(list(range(60)), sets, 80)
    label = list(range(60))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x, y in links:
        label[find(x)] = find(y)
    assert len({find(x) for x in range(30)}) == 1 and len({find(x) for x in range(30, 60)}) == 1 and find(0) != find(30)
    probe = [k >= 55 for k in range(60)]
    links = jaccard_join.link_group(list(range(60)), sets, 80, [0] * 30 + list(range(30, 60)), probe)
    assert links and all(y >= 55 or x >= 55 for x, y in links)


def test_keep_one_row_of_a_component(odd, texts):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert got.count(9) == 0 and got.count(8) == 1 and got.count(5) == 0 and got.count(4) == 1
    assert {1, 2, 3, 6, 7, 10, 11, 12, 14, 15, -7} <= set(got) and 13 not in got


def test_bpe(odd, texts):
    import public_tokenizers as P
    import tiktoken

    path = P.path(byte_bpe.RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = byte_bpe.decode(byte_bpe.encode(docs, path, most_words=50), path).collect()
    assert sorted((r["text"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == sorted((t or "", enc.encode_ordinary(t or "")) for _, t in texts)
    assert all(bytes(r["decoded"]) == r["text"].encode() for r in got)


def test_fold_equals_merges(spark):
    import public_tokenizers as P

    ranks = byte_bpe.load_ranks(P.path(byte_bpe.RANKS))
    rng = random.Random(6)
    words = sorted({"".join(rng.choice(k) for _ in range(rng.choice([1, 2, 4, 9, 25]))) for k in ["abcdefghi", "ab", "éèçà中", " the"] for _ in range(40)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["ids"] for r in df.select("word", byte_bpe.Bpe(ranks, P.PATTERN).fold(F.col("word")).alias("ids")).collect()}
    assert got == {w: byte_bpe.merge_word(w.encode(), ranks) for w in words}


def test_rare_words_are_merged_together(monkeypatch):
    import public_tokenizers as P
    import pyarrow as pa
    import tiktoken

    ranks = byte_bpe.load_ranks(P.path(byte_bpe.RANKS))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    rare = ["".join(rng.choice(k) for _ in range(rng.randint(1, 14))) for k in ["abcdefghi", "ab", "éèçà中", "tion", "12$'"] for _ in range(200)]
    texts = [" ".join(rng.choice(rare) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += ["", " ", "a  b", " a", "a ", "a\n b", "a \n", "a\u3000 b \u3000c", "\x1c \x1cx", "it's  they'll 'S\n\n\n x", "z" * 300 + " " + "é" * 90]
    monkeypatch.setattr(byte_bpe, "_merge_short", None)  # not one by one
    encoder, pieces = byte_bpe._Encoder({"aab": np.array(enc.encode_ordinary("aab"), "<u4").tobytes()}, ranks, P.PATTERN), byte_bpe.Pieces(ranks)
    for part in byte_bpe.slices(pa.array(texts * 2), 500):
        ids, counts = encoder.encode(part)
        want = [enc.encode_ordinary(t) for t in part.to_pylist()]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert pieces.join(ids, counts).to_pylist() == [t.encode() for t in part.to_pylist()]
    assert sum(map(len, byte_bpe.slices(pa.array(texts), 500))) == len(texts)


def test_parts_hold_the_words_of_their_text():
    import public_tokenizers as P
    import pyarrow as pa
    import regex

    blanks = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b"
    texts = [f"a{x}{y}b{y} {x}c {y}" for x in blanks for y in blanks] + [f"a{x} b" for x in blanks] + ["don't 1a!'s ''ll x"]
    find, words = regex.compile(P.PATTERN).findall, byte_bpe.words_of(P.PATTERN)
    parts, counts = byte_bpe.cut(pa.array(texts), P.PATTERN)
    parts = iter(parts.to_pylist())
    for text, n in zip(texts, counts.tolist()):
        own = [next(parts) for _ in range(n)]
        assert "".join(own) == text
        assert [w for p in own for w in words(p)] == find(text)
    assert byte_bpe.cut(pa.array(["a b", ""]), "[a-z ]+")[0].to_pylist() == ["a b", ""]
    assert all(words(chr(i)) == find(chr(i)) and words(f"a{chr(i)}1") == find(f"a{chr(i)}1") for i in range(128))


def test_packing(odd, texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path(packing.TOKENIZER))
    tok.encode_special_tokens = True
    rows = packing.pack(odd, P.path(packing.TOKENIZER)).collect()
    want = collections.Counter()
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.update((i, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)) for s in range(0, len(ids), 1024))
    assert collections.Counter(tuple(r[c] for c in ("id", "start", "length", "ids_crc32", "doc_tokens")) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_matches_are_those_of_the_parts_of_a_text():
    import public_tokenizers as P

    blanks = [chr(c) for c in range(0x110000) if regex.match(r"\s", chr(c))]
    rng = random.Random(8)
    letters = [*blanks, *"  \n\n", *"ab1'.é中\x1c\u200b", "'s", "'ll", "don't"]
    for n in range(4000):
        text = "".join(rng.choice(letters) for _ in range(n % 40))
        parts = byte_bpe.units_of(P.PATTERN)(text)
        assert "".join(parts) == text
        assert [m for part in parts for m in regex.findall(P.PATTERN, part)] == regex.findall(P.PATTERN, text)
    assert byte_bpe.units_of(P.PATTERN)("one two\nthree") == ["one", " two", "\nthree"]
    assert byte_bpe.units_of("[a-z ]+")("one two") == ["one two"]


def test_patterns_hold_every_piece_and_little_else():
    rng = np.random.default_rng(0)
    for n, top in ((3, 256), (500, 256), (30_000, 256), (30_000, 60)):
        found = dict(zip(*[x.tolist() for x in np.unique(rng.integers(1, top + 1, n), return_counts=True)]))
        plan = packing.plan_sequences(found, 256)
        held = collections.Counter()
        for pattern, times in plan:
            assert sum(c * k for c, k in pattern.items()) <= 256
            held.update({c: k * times for c, k in pattern.items()})
        assert held == found
        if n > 1000:
            assert sum(t for _, t in plan) < 1.01 * sum(c * k for c, k in found.items()) / 256 + 2


def test_language_model_base(odd, texts):
    train = odd.filter(suffix_tree_lm.fold(F.col("doc_id")) != 0)
    got = suffix_tree_lm.score(odd, train, chunk_bytes=50_000).collect()
    want = sorted(((i, *x[1:4]), x[4]) if i is not None else ((-99, *x[1:4]), x[4]) for (i, _), x in zip(texts, brute.base_scores(texts)))
    rows = sorted(((-99 if r["id"] is None else r["id"], r["n_tokens"], r["n_known"], r["train_tokens"]), r["base_score"]) for r in got)
    assert [r[0] for r in rows] == [w[0] for w in want]
    assert np.allclose([r[1] for r in rows], [w[1] for w in want], rtol=1e-9)


def test_states_of_the_suffix_tree_sum_to_one():
    rng = random.Random(3)
    seq = [0, 1]
    for _ in range(3000):
        likely = (2 * seq[-1] + seq[-2]) % 4
        seq.append(likely if rng.random() < 0.6 else rng.randrange(4))
    seq = np.array(seq)
    counts = np.bincount(seq, minlength=4)
    p, t = (np.unique(x, return_counts=True) for x in (seq[:-1] * 4 + seq[1:], (seq[:-2] * 4 + seq[1:-1]) * 4 + seq[2:]))
    tree = suffix_tree_lm.grow_tree(counts, p, t, p, len(seq), 4, gain=0.5)
    assert len(tree.contexts[0]) and len(tree.contexts[1])
    root = np.log10((np.append(counts, 0) + 0.1) / (len(seq) + 0.1 * 5))
    for depth in (0, 1):
        for state in tree.contexts[depth].tolist():
            before = [state // 4, state % 4] if depth else [state]
            total = 0.0
            for symbol in range(5):  # the last is the unknown word
                ids = np.array([*before, symbol if symbol < 4 else -1])
                logs = suffix_tree_lm.score_tokens(tree, ids, root[[*before, symbol]], np.array([0]))
                total += 10 ** logs[-1]
            assert abs(total - 1) < 1e-6


def test_quality_rules(odd, texts):
    rows = {(r["_id"], r["_h"]): r for r in quality_rules.judged(odd).collect()}
    assert len(rows) == 18
    assert sum(r["kept"] for r in rows.values()) >= 5 and not any(r["kept"] for r in rows.values() if r["n_words"] < 20)
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_neighbour_quality(spark, odd):
    rng = random.Random(7)
    rows = [(k, prose(rng, 80) if k % 3 else prose(rng, 80).upper().replace(" ", "!! "), int(k % 3 > 0)) for k in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows] + [(5, None), (None, 1), (9999, 1)], "doc_id long, quality int")
    model = neighbour_quality.fit(docs, labels, neighbour_quality.remainder(F.col("doc_id")) != 1, labelled=100)
    got = {r["id"]: r["score"] for r in neighbour_quality.score(docs, model).collect()}
    assert all((got[k] >= 0.5) == bool(q) for k, _, q in rows)
    odd_scores = neighbour_quality.score(odd, model).collect()
    assert len(odd_scores) == 19 and all(0 <= r["score"] <= 1 for r in odd_scores)
    assert {r["score"] for r in neighbour_quality.score(odd, None).collect()} == {0.5}


def test_empty_tables(spark, none):
    import public_tokenizers as P

    assert line_dedup.line_dedup(none).count() == 0
    assert suffix_dedup.suffix_dedup(none).count() == 0
    assert jaccard_join.similar_components(none).count() == 0
    assert quality_rules.judged(none).count() == 0
    assert packing.pack(none, P.path(packing.TOKENIZER)).count() == 0
    assert byte_bpe.encode(none.select("doc_id", "text"), P.path(byte_bpe.RANKS)).count() == 0
    assert suffix_tree_lm.score(none, none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert neighbour_quality.fit(none, labels, F.lit(True)) is None


def test_sha_of_what_is_left():
    assert suffix_dedup.remove_ranges(b"abcdef", [1, 1, 2, 2], 2) == (b"aef", 3, 1)
    assert hashlib.sha256(suffix_dedup.remove_ranges(b"abc", [], 2)[0]).hexdigest() == hashlib.sha256(b"abc").hexdigest()
