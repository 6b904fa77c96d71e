"""Text augmentation, row to row.

Operators that only need the row itself are column expressions. Operators that need a
dictionary or corpus counts explode the few chosen words (never the text), look them up by
an equi-join and bring back at most a handful of replacements per row. Only rows let
through by an operator's gate take part in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import gate, pick, randint, u
from ..functions.texts import join_words, words
from ..plans.lookup import chunk_lookup, salted_lookup, sparse_lookup
from ..plans.session import materialize
from .counts import neighbour_counts
from .vector_augment import image_steps


def gated(df: DataFrame, key: str, text: str, probability: float, expr: Column, seed: int, tag: str) -> DataFrame:
    """Apply a text expression with the given probability, else leave the text as it is."""
    return df.withColumn(text, F.when(gate(seed, tag, F.col(key), probability), expr).otherwise(F.col(text)))


def _gated_words(df: DataFrame, key: str, text: str, probability: float, seed: int, tag: str) -> DataFrame:
    # null for rows the gate leaves alone, so that the split is not paid for them
    on = gate(seed, tag, F.col(key), probability)
    return df.withColumn("_w", F.when(on, words(F.col(text)))).withColumn("_n", F.size("_w"))


# -- operators that need the row only ---------------------------------------------------


def random_deletion(
    df, key="doc_id", text="text", probability=0.05, rate=None, seed=42, tag="random_deletion", **_
) -> DataFrame:
    """Drop each word with ``rate`` (the gate probability unless given); never empty."""
    rate = probability if rate is None else rate
    k = F.col(key)
    kept = F.filter("_w", lambda w, i: u(seed, tag, k, i) > F.lit(float(rate)))
    df = _gated_words(df, key, text, probability, seed, tag).withColumn("_kept", F.when(F.col("_n") > 2, kept))
    one = F.get("_w", pick(u(seed, f"{tag}:pick", k, 0), F.col("_n")))
    new = F.when(F.size("_kept") == 0, one).otherwise(join_words(F.col("_kept")))
    return df.withColumn(text, F.when(F.col("_n") > 2, new).otherwise(F.col(text))).drop("_w", "_n", "_kept")


def random_swap(df, key="doc_id", text="text", probability=0.05, max_swaps=1, seed=42, tag="random_swap", **_) -> DataFrame:
    """Exchange two distinct words, ``max_swaps`` times in sequence."""
    k, n = F.col(key), F.col("_n")
    df = _gated_words(df, key, text, probability, seed, tag)
    df = df.withColumn("_w", F.when(n >= 2, F.col("_w"))).withColumn("_n", F.size("_w"))
    for t in range(int(max_swaps)):
        df = df.withColumn("_i", pick(u(seed, tag, k, 2 * t), n))
        df = df.withColumn("_j", ((F.col("_i") + 1 + pick(u(seed, tag, k, 2 * t + 1), n - 1)) % n).cast("int"))
        df = df.withColumn("_wi", F.get("_w", F.col("_i"))).withColumn("_wj", F.get("_w", F.col("_j")))
        df = df.withColumn(
            "_w",
            F.transform(
                "_w",
                lambda w, p: F.when(p == F.col("_i"), F.col("_wj")).when(p == F.col("_j"), F.col("_wi")).otherwise(w),
            ),
        )
    new = F.when(F.col("_w").isNotNull(), join_words(F.col("_w"))).otherwise(F.col(text))
    return df.withColumn(text, new).drop("_w", "_n", "_i", "_j", "_wi", "_wj")


def token_cutoff(df, key="doc_id", text="text", probability=0.1, cutoff_ratio=0.1, seed=42, tag="token_cutoff", **_) -> DataFrame:
    """Remove one span of ``max(1, int(n * ratio))`` words."""
    k, n = F.col(key), F.col("_n")
    df = _gated_words(df, key, text, probability, seed, tag)
    df = df.withColumn("_cut", F.greatest(F.lit(1), F.floor(n * F.lit(float(cutoff_ratio))).cast("int")))
    df = df.withColumn("_start", randint(u(seed, tag, k, 0), F.lit(0), n - F.col("_cut")))
    left = F.concat(
        F.slice("_w", F.lit(1), F.col("_start")),
        F.slice("_w", F.col("_start") + F.col("_cut") + 1, n),
    )
    usable = (n >= 4) & (F.col("_cut") < n)
    return df.withColumn(text, F.when(usable, join_words(left)).otherwise(F.col(text))).drop("_w", "_n", "_cut", "_start")


# -- operators with a dictionary --------------------------------------------------------


def build_lexicon(synsets: DataFrame, synset: str = "synset_id", lemma: str = "lemma") -> DataFrame:
    """(word, synonyms): the lemmas sharing a synset with a word, without the word itself in
    any case and without multi-word lemmas. Memberships are de-duplicated before the join,
    so its output is the dictionary itself."""
    members = synsets.select(F.col(synset).alias("_s"), F.col(lemma).alias("word")).distinct()
    others = members.withColumnRenamed("word", "synonym").filter(~F.col("synonym").contains("_"))
    pairs = (
        members.join(others, "_s")
        .filter(F.lower("word") != F.lower("synonym"))
        .select("word", "synonym")
        .distinct()
    )
    return pairs.groupBy("word").agg(F.array_sort(F.collect_set("synonym")).alias("synonyms"))


def _only_gated(df, on: Column, act: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    # the gated rows are clustered by key once; every later join or grouping by key reuses it
    done = act(df.filter(on).repartition(F.col(key)))
    return done.unionByName(df.filter(~on))


def synonym_replacement(
    df, key="doc_id", text="text", probability=0.1, max_replacements=2, method="wordnet",
    lexicon=None, seed=42, tag="synonym_replacement", split=True, **_,
) -> DataFrame:
    """Replace up to ``max_replacements`` distinct words by a synonym, where there is one.

    ``method='embedding'`` knows no synonyms, as no vectors are defined for it: the
    visited text only gets its blanks normalised.
    """
    if method != "wordnet" or lexicon is None:
        lexicon = _no_lexicon(df)
    k = F.col(key)

    def act(rows: DataFrame) -> DataFrame:
        rows = _gated_words(rows, key, text, probability, seed, tag)
        order = F.array_sort(
            F.transform("_w", lambda w, i: F.struct(u(seed, tag, k, i).alias("u"), i.alias("pos"), w.alias("word")))
        )
        chosen = (
            rows.filter(F.col("_n") >= 2)
            .select(key, F.explode(F.slice(order, 1, int(max_replacements))).alias("c"))
            .select(key, "c.pos", "c.word")
        )
        hits = sparse_lookup(chosen, lexicon, ["word"], [key, "pos"], how="inner").select(
            key,
            F.struct(
                F.col("pos"),
                F.get("synonyms", pick(u(seed, f"{tag}:choice", k, F.col("pos")), F.size("synonyms"))).alias("new"),
            ).alias("r"),
        )
        # at most max_replacements entries per row
        found = hits.groupBy(key).agg(F.map_from_entries(F.collect_list("r")).alias("_new"))
        out = rows.join(found, key, "left")
        replaced = F.transform("_w", lambda w, i: F.coalesce(F.try_element_at(F.col("_new"), i), w))
        new = F.when(F.col("_new").isNull(), join_words(F.col("_w"))).otherwise(join_words(replaced))
        return out.withColumn(text, F.when(F.col("_n") >= 2, new).otherwise(F.col(text))).drop("_w", "_n", "_new")

    return _only_gated(df, gate(seed, tag, k, probability), act, key) if split else act(df)


def random_insertion(
    df, key="doc_id", text="text", probability=0.1, max_insertions=1,
    lexicon=None, seed=42, tag="random_insertion", split=True, **_,
) -> DataFrame:
    """Insert a synonym of a random word at a random place, ``max_insertions`` times in
    sequence. Each round looks up one word per row."""
    if lexicon is None:
        lexicon = _no_lexicon(df)
    k, n = F.col(key), F.size("_w")

    def act(rows: DataFrame) -> DataFrame:
        rows = _gated_words(rows, key, text, probability, seed, tag)
        rows = rows.withColumn("_w", F.when(F.col("_n") >= 2, F.col("_w")))
        # a row goes through the lookup itself, so that rounds add up instead of multiplying;
        # rows that ask nothing get a key of their own, which no word can equal
        nothing = F.concat(F.lit(" "), k.cast("string"))
        for t in range(int(max_insertions)):
            rows = rows.withColumn("word", F.coalesce(F.get("_w", pick(u(seed, tag, k, 3 * t), n)), nothing))
            rows = salted_lookup(rows, lexicon, ["word"], [key])
            at = randint(u(seed, tag, k, 3 * t + 1), F.lit(0), n)
            found = F.get("synonyms", pick(u(seed, tag, k, 3 * t + 2), F.size("synonyms")))
            grown = F.concat(F.slice("_w", F.lit(1), at), F.array(found), F.slice("_w", at + 1, F.greatest(n, F.lit(1))))
            usable = F.col("_w").isNotNull() & F.col("synonyms").isNotNull()
            rows = rows.withColumn("_w", F.when(usable, grown).otherwise(F.col("_w"))).drop("word", "synonyms")
        new = F.when(F.col("_w").isNotNull(), join_words(F.col("_w"))).otherwise(F.col(text))
        return rows.withColumn(text, new).drop("_w", "_n")

    return _only_gated(df, gate(seed, tag, k, probability), act, key) if split else act(df)


def _no_lexicon(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "word string, synonyms array<string>")


# -- round trip through a pivot language ------------------------------------------------

# Fixed value: the languages a text may be sent through.
PIVOT_LANGUAGES = ("de", "fr", "es", "zh")


def back_translation(
    df, key="doc_id", text="text", probability=0.15, source_lang="en", pivot_lang="de",
    forward=None, backward=None, model=None, max_tokens=None, seed=42, tag="back_translation", split=True, **_,
) -> DataFrame:
    """Round trip through a pivot language, over whole texts. ``max_tokens`` keeps only so many
    first words, as translation models with a limit of 512 tokens do.

    With ``forward`` (word, pivot) and ``backward`` (pivot, word) phrase tables the trip is
    two equi-joins over the distinct words of chunks of texts; a word unknown to a table is kept. With ``model`` - a function without
    arguments returning ``translate(list[str]) -> list[str]`` - batches go through the
    model, loaded once per task; a text whose translation fails is returned as it was,
    while a model that cannot be loaded fails the job.
    """
    if pivot_lang not in PIVOT_LANGUAGES:
        raise ValueError(f"pivot_lang must be one of {PIVOT_LANGUAGES}")
    on = gate(seed, tag, F.col(key), probability)
    if model is not None:
        rewritten = _through_model(df.filter(on) if split else df.withColumn("_on", on), text, model)
        return rewritten.unionByName(df.filter(~on)) if split else rewritten.drop("_on")
    if forward is None or backward is None:
        raise ValueError("back_translation needs phrase tables or a model")

    def act(rows: DataFrame) -> DataFrame:
        rows = _gated_words(rows, key, text, probability, seed, tag)
        kept = F.col("_w") if max_tokens is None else F.slice("_w", 1, int(max_tokens))

        def trips(asked: DataFrame) -> DataFrame:
            there = asked.join(forward.withColumnRenamed("word", "tok"), "tok", "left").withColumn("pivot", F.coalesce("pivot", "tok"))
            back = backward.select("pivot", F.col("word").alias("_back"))
            return there.join(back, "pivot", "left").select("chunk", "tok", F.coalesce("_back", "pivot").alias("value"))

        told = chunk_lookup(rows.withColumn("_w", kept), key, "_w", trips, "_said", T.StringType(), keep=False)
        said = F.when(F.size("_said") > 0, F.array_join("_said", " "))
        return told.withColumn(text, F.coalesce(said, text)).drop("_n", "_said")

    return _only_gated(df, on, act, key) if split else act(df)


def _all_or_each(model: Callable[[list[str]], list], texts: list[str]) -> list:
    """What a model makes of some texts: called once, or, where that fails, text by text, with None for those that fail alone."""
    if not texts:
        return []
    try:
        return list(model(texts))
    except Exception:  # some text of the batch
        out = []
        for t in texts:
            try:
                out.append(model([t])[0])
            except Exception:  # this text
                out.append(None)
        return out


def _through_model(df: DataFrame, text: str, load) -> DataFrame:
    everything = "_on" not in df.columns

    def run(batches: Iterator) -> Iterator:
        translate = load()
        for pdf in batches:
            act = [True] * len(pdf) if everything else [bool(a) for a in pdf["_on"]]
            asked = [t for t, a in zip(pdf[text], act) if a]
            told = iter(_all_or_each(translate, asked))
            yield pdf.assign(**{text: [t if not a or (new := next(told)) is None else new for t, a in zip(pdf[text], act)]})

    return df.mapInPandas(run, df.schema)


# -- insertion of words that fit their neighbours ---------------------------------------


def bigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, follower, n) over all neighbouring words of the corpus."""
    return neighbour_counts(df, text, "word", "follower", "n")


def _top(bigrams: DataFrame, by: str, of: str, k: int) -> DataFrame:
    # Spark keeps the k best of a word in every task before rows are shuffled, so that no task ranks all neighbours of a common word
    w = W.partitionBy(by).orderBy(F.desc("n"), F.col(of))
    best = bigrams.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return best.groupBy(by).agg(F.collect_list(F.struct(F.col(of).alias("cand"), "n")).alias("_best"))


def contextual_insertion(
    df, key="doc_id", text="text", probability=0.1, bigrams=None, top_k=5, model=None,
    seed=42, tag="contextual_insertion", split=True, **_,
) -> DataFrame:
    """Insert, between two words, one of the ``top_k`` words that fit best, chosen at random.

    Without a model, the words considered are the ``top_k`` commonest followers of the left
    neighbour and the ``top_k`` commonest predecessors of the right one; they are scored by
    (1 + count(left, w)) * (1 + count(w, right)), ties by word. With ``model`` (a function
    without arguments returning ``fill(list[str]) -> list[list[str]]``) the candidates come
    from it; it sees the text with a ``[MASK]``.
    """
    k = F.col(key)
    on = gate(seed, tag, k, probability)
    top_k = int(top_k)

    def place(rows: DataFrame) -> DataFrame:
        rows = _gated_words(rows, key, text, probability, seed, tag)
        return rows.withColumn("_at", F.when(F.col("_n") >= 3, randint(u(seed, tag, k, 0), F.lit(1), F.col("_n") - 1)))

    def insert(rows: DataFrame) -> DataFrame:
        at, n = F.col("_at"), F.col("_n")
        grown = F.concat(F.slice("_w", F.lit(1), at), F.array("_new"), F.slice("_w", at + 1, F.greatest(n, F.lit(1))))
        return rows.withColumn(text, F.when(F.col("_new").isNotNull(), join_words(grown)).otherwise(F.col(text))).drop(
            "_w", "_n", "_at", "_new", "_d"
        )

    def act(rows: DataFrame) -> DataFrame:
        rows = place(rows)
        spots = rows.filter(F.col("_at").isNotNull()).select(
            key,
            F.get("_w", F.col("_at") - 1).alias("left"),
            F.get("_w", F.col("_at")).alias("right"),
        )
        # every pair of neighbours is worked out once, however many rows have it. The table of bigrams is never repeated for salts: what is salted are the
        # neighbours of words asked about and the counts of pairs asked about, and what is asked is stored, as it is read several times
        spots = materialize(spots, "spots")
        asked = spots.select("left", "right").distinct()
        after = _top(bigrams, "word", "follower", top_k).select(F.col("word").alias("left"), "_best")
        ahead = _top(bigrams, "follower", "word", top_k).select(F.col("follower").alias("right"), "_best")
        after = sparse_lookup(asked, after, ["left"], ["right"], how="inner").select("left", "right", F.inline("_best"))
        ahead = sparse_lookup(asked, ahead, ["right"], ["left"], how="inner").select("left", "right", F.inline("_best"))
        nothing = F.lit(None).cast("long")
        both = after.select("left", "right", "cand", F.col("n").alias("_ln"), nothing.alias("_rn")).unionByName(
            ahead.select("left", "right", "cand", nothing.alias("_ln"), F.col("n").alias("_rn"))
        )
        cands = both.groupBy("left", "right", "cand").agg(F.max("_ln").alias("_ln"), F.max("_rn").alias("_rn"))
        # a candidate comes with the count on one side; the other side is a pair to look up, if it did not come with both
        ask_left, ask_right = F.col("_ln").isNull(), F.col("_rn").isNull()
        cands = cands.withColumn("word", F.when(ask_left, F.col("left")).when(ask_right, F.col("cand")))
        cands = cands.withColumn("follower", F.when(ask_left, F.col("cand")).when(ask_right, F.col("right")))
        cands = materialize(cands, "candidates")
        wanted = cands.filter(F.col("word").isNotNull()).select("word", "follower").distinct()
        known = bigrams.select("word", "follower", "n").join(wanted, ["word", "follower"], "left_semi")
        lc, rc = (F.coalesce(c, "n", F.lit(0)) for c in ("_ln", "_rn"))
        scored = salted_lookup(cands, known, ["word", "follower"], ["left", "right"]).select(
            "left", "right", F.struct((-(1 + lc) * (1 + rc)).alias("s"), F.col("cand").alias("w")).alias("c")
        )
        # at most 2 * top_k candidates per pair
        best = scored.groupBy("left", "right").agg(F.slice(F.array_sort(F.collect_list("c")), 1, top_k).alias("_c"))
        best = salted_lookup(spots, best, ["left", "right"], [key], how="inner")
        best = best.select(key, F.get("_c", pick(u(seed, tag, k, 1), F.size("_c")))["w"].alias("_new"))
        best = materialize(best, "insertions")
        return insert(rows.join(best, key, "left"))

    def act_model(rows: DataFrame) -> DataFrame:
        rows = place(rows).withColumn("_d", u(seed, tag, k, 1)).withColumn("_new", F.lit(None).cast("string"))

        def run(batches: Iterator) -> Iterator:
            fill = model()
            for pdf in batches:
                masked = [None if ws is None or at is None or at != at else " ".join([*ws[: int(at)], "[MASK]", *ws[int(at) :]]) for ws, at in zip(pdf["_w"], pdf["_at"])]
                told = iter(_all_or_each(fill, [t for t in masked if t is not None]))
                new = []
                for t, d in zip(masked, pdf["_d"]):
                    found = (next(told) if t is not None else None) or []
                    found = found[:top_k]
                    new.append(found[int(d * len(found))].strip() if found else None)
                yield pdf.assign(_new=new)

        return insert(rows.mapInPandas(run, rows.schema))

    if model is not None:
        return act_model(df.filter(on)).unionByName(df.filter(~on)) if split else act_model(df)
    if bigrams is None:
        raise ValueError("contextual_insertion needs bigram counts or a model")
    return _only_gated(df, on, act, key) if split else act(df)


# -- declarative composition ------------------------------------------------------------

_ROW_ONLY = {"random_deletion": random_deletion, "random_swap": random_swap, "token_cutoff": token_cutoff}
_LOOKUP = {
    "synonym_replacement": synonym_replacement,
    "random_insertion": random_insertion,
    "back_translation": back_translation,
    "contextual_insertion": contextual_insertion,
}
# The probability each augmentation has when its entry names none.
_DEFAULT_PROBABILITY = {
    "synonym_replacement": 0.1,
    "random_insertion": 0.1,
    "random_deletion": 0.05,
    "random_swap": 0.05,
    "back_translation": 0.15,
    "token_cutoff": 0.1,
    "contextual_insertion": 0.1,
}
_REGISTERED: dict[str, Callable] = {}


def register_augmentation(name: str, fn: Callable[..., DataFrame]) -> None:
    """Make ``fn(df, key=, text=, seed=, tag=, **params)`` usable in a config by name."""
    _REGISTERED[name] = fn


def register_expression(name: str, expr: Callable[..., Column], probability: float = 0.5) -> None:
    """Make a text expression ``expr(text column, **params)`` usable in a config by name; it acts
    on the share of rows given by the entry's probability."""

    def apply(df, key, text, seed, tag, probability=probability, **params):
        return gated(df, key, text, probability, expr(F.col(text), **params), seed, tag)

    _REGISTERED[name] = apply


class TextAugmenter:
    """Applies the enabled text augmentations of a config, in their order.

    The position of an entry is part of its draw key, so the same augmentation listed twice
    acts differently each time. Whether a row needs a dictionary at all follows from its
    key alone, so rows that need none skip every join of the whole chain.

    ``tables`` are what the enabled entries look things up in: ``lexicon``, ``forward`` and
    ``backward`` phrase tables, ``bigrams``, and ``models``, a dict from model names to loaders.
    """

    def __init__(self, config: dict, key: str = "doc_id", text: str = "text", seed: int = 42, **tables):
        section = config.get("pipeline", {})
        self.enabled = bool(section.get("enabled", False))
        self.key, self.text, self.seed, self.tables = key, text, seed, tables
        self.entries: list[tuple[str, str, dict]] = []
        self.image_entries: list[tuple[str, dict]] = []
        if self.enabled:
            known = {**_ROW_ONLY, **_LOOKUP, **_REGISTERED}
            wanted = [e for e in section.get("text_augmentations", []) if e.get("enabled", False) and e["name"] in known]
            for i, e in enumerate(wanted):
                params = {k: v for k, v in e.items() if k not in ("name", "enabled")}
                self.entries.append((e["name"], f"{i}.{e['name']}", params))
            self.image_entries = image_steps(config)

    def __len__(self) -> int:
        return len(self.entries)

    def __repr__(self) -> str:
        if not self.enabled:
            return "TextAugmenter(disabled)"
        return f"TextAugmenter(text={[n for n, _, _ in self.entries]}, image={'yes' if self.image_entries else 'no'})"

    def _step(self, df: DataFrame, name: str, tag: str, params: dict) -> DataFrame:
        common = dict(key=self.key, text=self.text, seed=self.seed, tag=tag)
        if isinstance(params.get("model"), str):
            # a config names its model; without a loader of that name the corpus counts are used
            params = {**params, "model": self.tables.get("models", {}).get(params["model"])}
        if name in _REGISTERED:
            return _REGISTERED[name](df, **common, **params)
        if name in _LOOKUP:
            return _LOOKUP[name](df, **common, **{**self.tables, **params}, split=False)
        return _ROW_ONLY[name](df, **common, **params)

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.entries:
            return df
        gates = [
            gate(self.seed, tag, F.col(self.key), p.get("probability", _DEFAULT_PROBABILITY[name]))
            for name, tag, p in self.entries
            if name in _LOOKUP and name not in _REGISTERED
        ]
        if not gates:
            return self._fold(df, lookups=True)
        needs = gates[0]
        for g in gates[1:]:
            needs = needs | g
        looked_up = self._fold(df.filter(needs).repartition(F.col(self.key)), lookups=True)
        return looked_up.unionByName(self._fold(df.filter(~needs), lookups=False))

    def _fold(self, df: DataFrame, lookups: bool) -> DataFrame:
        joins = [tag for name, tag, _ in self.entries if name in _LOOKUP and name not in _REGISTERED]
        for name, tag, params in self.entries:
            if lookups or tag not in joins:
                df = self._step(df, name, tag, params)
            if lookups and tag in joins[:-1]:
                # a lookup reads its rows more than once; written here, the steps before it run once
                df = materialize(df, "augmented")
        return df


def needs_lookup(augmenter: TextAugmenter) -> bool:
    """Whether any step joins a dictionary or corpus table."""
    return any(name in _LOOKUP and name not in _REGISTERED for name, _, _ in augmenter.entries)
