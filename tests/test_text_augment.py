from pyspark.sql import functions as F

from trialweave.operators import text_augment as T

SENTENCE = "The quick brown fox jumps over the lazy dog"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def texts(df):
    return [r.text for r in df.orderBy("doc_id").collect()]


def copies(spark, text, n=200):
    return docs(spark, *[text] * n)


def test_deletion_shrinks_and_keeps_something(spark):
    out = texts(T.random_deletion(copies(spark, SENTENCE), probability=1.0, rate=0.5))
    assert all(0 < len(t.split()) <= 9 for t in out) and len(set(out)) > 50
    assert all(set(t.split()) <= set(SENTENCE.split()) for t in out)
    assert set(texts(T.random_deletion(copies(spark, "Hi"), probability=1.0))) == {"Hi"}
    # all words dropped: one of them stays
    left = texts(T.random_deletion(copies(spark, "a b c d"), probability=1.0, rate=1.0))
    assert set(left) == {"a", "b", "c", "d"}


def test_swap_is_a_permutation(spark):
    for swaps in (1, 4):
        out = texts(T.random_swap(copies(spark, "word1 word2 word3 word4"), probability=1.0, max_swaps=swaps))
        assert all(sorted(t.split()) == ["word1", "word2", "word3", "word4"] for t in out)
    one = texts(T.random_swap(copies(spark, "word1 word2 word3 word4"), probability=1.0))
    assert all(sum(a != b for a, b in zip(t.split(), ["word1", "word2", "word3", "word4"])) == 2 for t in one)
    assert texts(T.random_swap(docs(spark, "hello", "", "  "), probability=1.0)) == ["hello", "", "  "]


def test_cutoff_length(spark):
    ten = "one two three four five six seven eight nine ten"
    out = texts(T.token_cutoff(copies(spark, ten), probability=1.0, cutoff_ratio=0.3))
    assert {len(t.split()) for t in out} == {7} and len(set(out)) == 8
    assert texts(T.token_cutoff(docs(spark, "ab"), probability=1.0)) == ["ab"]


def test_probability_zero_is_identity_and_visited_texts_are_normalised(spark):
    raw = " a  b\tc d\n"
    for op in (T.random_deletion, T.random_swap, T.token_cutoff):
        assert texts(op(docs(spark, raw), probability=0.0)) == [raw]
    assert texts(T.random_swap(docs(spark, raw), probability=1.0, max_swaps=0)) == ["a b c d"]


def test_null_text_stays_null(spark):
    for op in (T.random_deletion, T.random_swap, T.token_cutoff):
        assert texts(op(docs(spark, None, "a b c d"), probability=1.0))[0] is None


def lexicon(spark, pairs):
    return spark.createDataFrame(list(pairs.items()), "word string, synonyms array<string>")


def test_synonyms(spark):
    lex = lexicon(spark, {"a": ["x", "y"], "b": ["z"]})
    out = texts(T.synonym_replacement(copies(spark, "a b c"), probability=1.0, max_replacements=2, lexicon=lex))
    allowed = [{"a", "x", "y"}, {"b", "z"}, {"c"}]
    assert all(w in ok for t in out for w, ok in zip(t.split(), allowed)) and len(set(out)) >= 4
    assert all(sum(w != o for w, o in zip(t.split(), "abc")) <= 2 for t in out)
    assert texts(T.synonym_replacement(docs(spark, "a"), probability=1.0, lexicon=lex)) == ["a"]
    same = texts(T.synonym_replacement(copies(spark, "a b c"), probability=1.0, method="embedding", lexicon=lex))
    assert set(same) == {"a b c"}


def test_insertion_brute_force(spark):
    lex = lexicon(spark, {"a": ["x", "y"], "b": ["z"], "x": ["a"]})
    for rounds in (1, 3):
        out = texts(T.random_insertion(copies(spark, "a b c"), probability=1.0, max_insertions=rounds, lexicon=lex))
        assert all(3 <= len(t.split()) <= 3 + rounds for t in out)
        assert all([w for w in t.split() if w in "bc"] == ["b", "c"] for t in out)
    assert texts(T.random_insertion(docs(spark, "a"), probability=1.0, lexicon=lex)) == ["a"]


def test_lexicon_excludes_itself_and_underscores(spark):
    s = spark.createDataFrame([(1, "dog"), (1, "Dog"), (1, "hot_dog"), (1, "hound"), (2, "dog"), (2, "chase")], "synset_id int, lemma string")
    lex = {r.word: r.synonyms for r in T.build_lexicon(s).collect()}
    assert lex["dog"] == ["chase", "hound"] and lex["hound"] == ["Dog", "dog"] and lex["hot_dog"] == ["Dog", "dog", "hound"]


def test_back_translation(spark):
    fwd = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", "p2")], "word string, pivot string")
    bwd = spark.createDataFrame([("p1", "A"), ("p2", "B")], "pivot string, word string")
    out = texts(T.back_translation(docs(spark, "a b c d", "", "a"), probability=1.0, forward=fwd, backward=bwd))
    assert out == ["A B B d", "", "A"]
    cut = texts(T.back_translation(docs(spark, "a b c d"), probability=1.0, forward=fwd, backward=bwd, max_tokens=2))
    assert cut == ["A B"]

    def load():
        def translate(batch):
            if "bad" in batch[0]:
                raise RuntimeError("no translation")
            return [t.upper() for t in batch]

        return translate

    assert texts(T.back_translation(docs(spark, "ok", "bad one"), probability=1.0, model=load)) == ["OK", "bad one"]


def test_contextual_insertion(spark):
    d = docs(spark, "a b c", "a b c", "a x b", "q")
    out = texts(T.contextual_insertion(d, probability=1.0, bigrams=T.bigram_counts(d)))
    assert out[3] == "q" and all(len(t.split()) == 4 for t in out[:3])
    filled = texts(T.contextual_insertion(d, probability=1.0, model=lambda: lambda ts: [[" new "] for _ in ts]))
    assert all("new" in t.split()[1:-1] for t in filled[:3]) and filled[3] == "q"


def test_contextual_insertion_repeats_no_bigrams(spark, monkeypatch):
    import collections

    from trialweave.functions.draws import u
    from trialweave.plans import lookup

    rows = ["the a b the c", "the b the a the b", "x the b y the", "a b a b c", "the the the the", "lone pair", "q"]
    counts = collections.Counter(p for t in rows for p in zip(t.split(), t.split()[1:]))
    counts.update({("the", f"w{i}"): 1 + i % 3 for i in range(300)} | {(f"v{i}", "the"): 2 for i in range(300)} | {(f"v{i}", f"w{i}"): 9 for i in range(300)})
    bigrams = spark.createDataFrame([(*p, n) for p, n in counts.items()], "word string, follower string, n long")
    repeated = []

    def counted(rows, dimension, on, salt_by, how="left"):
        repeated.append(dimension.count())
        return plain(rows, dimension, on, salt_by, how)

    plain = lookup.salted_lookup
    monkeypatch.setattr(lookup, "salted_lookup", counted)
    monkeypatch.setattr(T, "salted_lookup", counted)
    d = docs(spark, *rows)
    got = texts(T.contextual_insertion(d, probability=1.0, bigrams=bigrams, top_k=3, seed=7))
    draws = d.select("doc_id", *[u(7, "contextual_insertion", F.col("doc_id"), i).alias(f"u{i}") for i in (0, 1)]).orderBy("doc_id").collect()
    for text, new, (_, u0, u1) in zip(rows, got, draws):
        w = text.split()
        if len(w) >= 3:
            at = 1 + int(u0 * (len(w) - 1))
            left, right = w[at - 1], w[at]
            after = sorted((-n, b) for (a, b), n in counts.items() if a == left)[:3]
            ahead = sorted((-n, a) for (a, b), n in counts.items() if b == right)[:3]
            best = sorted((-(1 + counts.get((left, c), 0)) * (1 + counts.get((c, right), 0)), c) for c in {c for _, c in after + ahead})[:3]
            w.insert(at, best[int(u1 * len(best))][1])
            text = " ".join(w)
        assert new == text
    assert len(repeated) >= 4 and max(repeated) < 60 < len(counts)


def config(enabled, *entries):
    return {"pipeline": {"enabled": enabled, "text_augmentations": list(entries)}}


def test_chain(spark):
    off = T.TextAugmenter(config(False, {"name": "random_deletion", "enabled": True, "probability": 0.5}))
    d = docs(spark, "hello", SENTENCE)
    assert off.apply(d) is d and len(off) == 0 and "disabled" in repr(off)
    on = T.TextAugmenter(
        config(
            True,
            {"name": "random_deletion", "enabled": True, "probability": 0.1},
            {"name": "random_swap", "enabled": False, "probability": 0.1},
            {"name": "nonsense", "enabled": True, "probability": 0.1},
        )
    )
    assert len(on) == 1 and "random_deletion" in repr(on) and "random_swap" not in repr(on)


def test_registered_augmentation(spark):
    T.register_augmentation("shout", lambda df, text, **_: df.withColumn(text, F.upper(text)))
    out = T.TextAugmenter(config(True, {"name": "shout", "enabled": True})).apply(docs(spark, "a"))
    assert texts(out) == ["A"]
    T.register_expression("mark", lambda t, sign="!": F.concat(t, F.lit(sign)))
    half = T.TextAugmenter(config(True, {"name": "mark", "enabled": True, "sign": "?"})).apply(copies(spark, "a"))
    assert 60 < texts(half).count("a?") < 140 and set(texts(half)) == {"a", "a?"}


def test_same_result_for_any_partitioning(spark):
    lex = lexicon(spark, {"quick": ["fast"], "lazy": ["idle"], "dog": ["hound"], "the": ["a"]})
    chain = T.TextAugmenter(
        config(
            True,
            {"name": "synonym_replacement", "enabled": True, "probability": 0.6},
            {"name": "random_insertion", "enabled": True, "probability": 0.6},
            {"name": "random_deletion", "enabled": True, "probability": 0.3},
            {"name": "random_deletion", "enabled": True, "probability": 0.3},
        ),
        lexicon=lex,
    )
    d = copies(spark, SENTENCE, 300)
    assert texts(chain.apply(d.repartition(1))) == texts(chain.apply(d.repartition(7)))


def test_every_entry_of_a_full_config(spark):
    entries = [
        {"name": "synonym_replacement", "probability": 0.5, "max_replacements": 2, "method": "wordnet"},
        {"name": "random_insertion", "probability": 0.5, "max_insertions": 1},
        {"name": "random_deletion", "probability": 0.2},
        {"name": "random_swap", "probability": 0.2, "max_swaps": 1},
        {"name": "back_translation", "probability": 0.3, "source_lang": "en", "pivot_lang": "de"},
        {"name": "token_cutoff", "probability": 0.3, "cutoff_ratio": 0.1},
        {"name": "contextual_insertion", "probability": 0.3, "model": "some-masked-model"},
    ]
    d = copies(spark, SENTENCE, 120)
    tables = dict(
        lexicon=lexicon(spark, {"quick": ["fast"], "lazy": ["idle"]}),
        forward=spark.createDataFrame([("dog", "Hund")], "word string, pivot string"),
        backward=spark.createDataFrame([("Hund", "hound")], "pivot string, word string"),
        bigrams=T.bigram_counts(d),
    )
    chain = T.TextAugmenter(config(True, *[{**e, "enabled": True} for e in entries]), **tables)
    out = texts(chain.apply(d))
    assert len(chain) == 7 and len(out) == 120 and len(set(out)) > 60
    assert any("fast" in t for t in out) and any("hound" in t for t in out)
    named = {"some-masked-model": lambda: lambda ts: [["FILLED"] for _ in ts]}
    assert any("FILLED" in t for t in texts(T.TextAugmenter(chain_config(entries), models=named, **tables).apply(d)))


def chain_config(entries):
    return config(True, *[{**e, "enabled": True} for e in entries])
