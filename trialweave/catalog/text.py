"""Registered queries: text augmentation over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text_augment as T
from ..operators.prepare import rank_tokens, token_counts, tokenize
from ..plans.session import materialize
from ..sources.tables import table
from .kit import TOKENS_CTE, VOCAB_CTE, gate_sql, pick_sql, randint_sql, u_sql, words_sql

QUERIES, SQL = {}, {}


def _docs(spark, d):
    return table(spark, d, "documents", "doc_id", "text", many_tasks=True)


def _digest(df):
    return df.select("doc_id", F.md5("text").alias("text_md5"))


def vocab_lexicon(spark, d):
    """A dictionary grown from the corpus: words of neighbouring frequency rank are synonyms."""
    ranked = rank_tokens(token_counts(tokenize(_docs(spark, d), lower=True)))
    pairs = ranked.groupBy(F.floor(F.col("rank") / 2).alias("p")).agg(
        F.min_by("tok", "rank").alias("a"), F.max_by("tok", "rank").alias("b"), F.count(F.lit(1)).alias("n")
    )
    both = F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("s")), F.struct(F.col("b").alias("w"), F.col("a").alias("s")))
    return pairs.filter("n = 2").select(F.explode(both).alias("e")).select(
        F.col("e.w").alias("word"), F.array("e.s").alias("synonyms")
    )


def stored_lexicon(spark, d):
    """The dictionary as a table of its own: operators look it up several times."""
    return materialize(vocab_lexicon(spark, d), "lexicon")


# pairs of ranks (0,1), (2,3), ...: the partner of rank r is r XOR 1
LEXICON_CTE = (
    f"{VOCAB_CTE}, lex AS (SELECT a.tok AS word, b.tok AS syn FROM vocab a JOIN vocab b ON b.rank = xor(a.rank, 1))"
)
D = "d.doc_id"


def c1_gated(spark, d):
    return _digest(T.gated(_docs(spark, d), "doc_id", "text", 0.5, F.reverse("text"), 42, "reverse"))


QUERIES["c1_gated"] = c1_gated
SQL["c1_gated"] = (
    f"SELECT doc_id, md5(CASE WHEN {gate_sql(42, 'reverse', 'doc_id', 0.5)} THEN reverse(text) ELSE text END) AS text_md5 FROM documents"
)


def c2_synonym_replacement(spark, d):
    return _digest(T.synonym_replacement(_docs(spark, d), probability=0.3, max_replacements=3, lexicon=stored_lexicon(spark, d)))


QUERIES["c2_synonym_replacement"] = c2_synonym_replacement
_op = "synonym_replacement"
SQL["c2_synonym_replacement"] = f"""
WITH {TOKENS_CTE}, {LEXICON_CTE},
g AS (SELECT doc_id, ws FROM toks WHERE {gate_sql(42, _op, 'doc_id', 0.3)} AND len(ws) >= 2),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {u_sql(42, _op, 'doc_id', 'pos')}, pos) AS rn FROM w),
n AS (SELECT r.doc_id, r.pos, coalesce(CASE WHEN r.rn <= 3 THEN lex.syn END, r.word) AS word FROM r LEFT JOIN lex ON lex.word = r.word),
j AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM n GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(j.text, d.text)) AS text_md5 FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id
"""


def c2a_build_lexicon(spark, d):
    part = table(spark, d, "part", "p_name", "p_brand")
    synsets = part.select(F.col("p_brand").alias("synset_id"), F.explode(F.split("p_name", " ")).alias("lemma"))
    # lemmas with an underscore and lemmas differing in case only, to exercise both exclusions
    named = part.select(
        F.col("p_brand").alias("synset_id"),
        F.explode(F.array(F.replace("p_name", F.lit(" "), F.lit("_")), F.upper(F.split("p_name", " ")[0]))).alias("lemma"),
    )
    lex = T.build_lexicon(synsets.unionByName(named))
    return lex.select("word", F.size("synonyms").cast("bigint").alias("n"), F.array_join("synonyms", ",").alias("synonyms"))


QUERIES["c2a_build_lexicon"] = c2a_build_lexicon
SQL["c2a_build_lexicon"] = """
WITH s AS (SELECT p_brand AS synset_id, unnest(string_split(p_name, ' ')) AS lemma FROM part
  UNION SELECT p_brand, replace(p_name, ' ', '_') FROM part
  UNION SELECT p_brand, upper(string_split(p_name, ' ')[1]) FROM part),
p AS (SELECT DISTINCT a.lemma AS word, b.lemma AS syn FROM s a JOIN s b USING (synset_id)
  WHERE lower(a.lemma) <> lower(b.lemma) AND NOT contains(b.lemma, '_'))
SELECT word, count(*)::BIGINT AS n, string_agg(syn, ',' ORDER BY syn) AS synonyms FROM p GROUP BY word
"""


def c3_random_insertion(spark, d):
    return _digest(T.random_insertion(_docs(spark, d), probability=0.3, max_insertions=2, lexicon=stored_lexicon(spark, d)))


QUERIES["c3_random_insertion"] = c3_random_insertion
_op3 = "random_insertion"


def _insert_round(src: str, t: int) -> str:
    return f"""
a{t} AS (SELECT s.doc_id, s.ws, lex.syn, {randint_sql(u_sql(42, _op3, 's.doc_id', 3 * t + 1), '0', 'len(s.ws)')} AS spot FROM {src} s
  LEFT JOIN lex ON lex.word = s.ws[{pick_sql(u_sql(42, _op3, 's.doc_id', 3 * t), 'len(s.ws)')} + 1]),
r{t} AS (SELECT doc_id, CASE WHEN syn IS NULL THEN ws ELSE list_concat(list_concat(ws[1:spot], [syn]), ws[spot + 1:len(ws)]) END AS ws FROM a{t})"""


SQL["c3_random_insertion"] = f"""
WITH {TOKENS_CTE}, {LEXICON_CTE},
g AS (SELECT doc_id, ws FROM toks WHERE {gate_sql(42, _op3, 'doc_id', 0.3)} AND len(ws) >= 2),
{_insert_round('g', 0)}, {_insert_round('r0', 1)}
SELECT d.doc_id, md5(coalesce(array_to_string(r1.ws, ' '), d.text)) AS text_md5 FROM documents d LEFT JOIN r1 ON r1.doc_id = d.doc_id
"""


def deletion_sql(src: str, tag: str, p: float, rate: float) -> str:
    """(doc_id, text) -> (doc_id, text)"""
    return f"""(SELECT doc_id, CASE WHEN NOT on_ OR len(ws) <= 2 THEN text WHEN len(kept) = 0
      THEN ws[{pick_sql(u_sql(42, tag + ':pick', 'doc_id', 0), 'len(ws)')} + 1] ELSE array_to_string(kept, ' ') END AS text
    FROM (SELECT *, list_filter(ws, lambda w, i: {u_sql(42, tag, 'doc_id', 'i - 1')} > {rate}::DOUBLE) AS kept
      FROM (SELECT doc_id, text, {gate_sql(42, tag, 'doc_id', p)} AS on_, {words_sql('text')} AS ws FROM {src})))"""


def swap_sql(src: str, tag: str, p: float, swaps: int = 1) -> str:
    inner = f"(SELECT doc_id, text, {gate_sql(42, tag, 'doc_id', p)} AS on_, {words_sql('text')} AS ws FROM {src})"
    for t in range(swaps):
        i = f"(CASE WHEN len(ws) >= 2 THEN {pick_sql(u_sql(42, tag, 'doc_id', 2 * t), 'len(ws)')} END)"
        inner = f"(SELECT *, {i} AS i{t} FROM {inner})"
        j = f"(CASE WHEN len(ws) >= 2 THEN (i{t} + 1 + {pick_sql(u_sql(42, tag, 'doc_id', 2 * t + 1), 'len(ws) - 1')}) % len(ws) END)"
        inner = f"(SELECT *, {j} AS j{t} FROM {inner})"
        inner = f"""(SELECT * REPLACE (CASE WHEN len(ws) >= 2 THEN list_transform(ws, lambda w, q: CASE WHEN q - 1 = i{t} THEN ws[j{t} + 1]
            WHEN q - 1 = j{t} THEN ws[i{t} + 1] ELSE w END) ELSE ws END AS ws) FROM {inner})"""
    return f"(SELECT doc_id, CASE WHEN on_ AND len(ws) >= 2 THEN array_to_string(ws, ' ') ELSE text END AS text FROM {inner})"


def cutoff_sql(src: str, tag: str, p: float, ratio: float) -> str:
    cut = f"greatest(1, floor(len(ws) * {ratio}::DOUBLE)::BIGINT)"
    start = randint_sql(u_sql(42, tag, "doc_id", 0), "0", "len(ws) - cut")
    return f"""(SELECT doc_id, CASE WHEN on_ AND len(ws) >= 4 THEN array_to_string(list_concat(ws[1:start], ws[start + cut + 1:len(ws)]), ' ')
      ELSE text END AS text FROM (SELECT *, {start} AS start FROM (SELECT *, {cut} AS cut FROM
      (SELECT doc_id, text, {gate_sql(42, tag, 'doc_id', p)} AS on_, {words_sql('text')} AS ws FROM {src}))))"""


def _rows(sql: str) -> str:
    return f"SELECT doc_id, md5(text) AS text_md5 FROM {sql}"


def c4_random_deletion(spark, d):
    return _digest(T.random_deletion(_docs(spark, d), probability=0.3))


QUERIES["c4_random_deletion"] = c4_random_deletion
SQL["c4_random_deletion"] = _rows(deletion_sql("documents", "random_deletion", 0.3, 0.3))


def c5_random_swap(spark, d):
    return _digest(T.random_swap(_docs(spark, d), probability=0.4, max_swaps=3))


QUERIES["c5_random_swap"] = c5_random_swap
SQL["c5_random_swap"] = _rows(swap_sql("documents", "random_swap", 0.4, 3))


def c6_token_cutoff(spark, d):
    return _digest(T.token_cutoff(_docs(spark, d), probability=0.4, cutoff_ratio=0.2))


QUERIES["c6_token_cutoff"] = c6_token_cutoff
SQL["c6_token_cutoff"] = _rows(cutoff_sql("documents", "token_cutoff", 0.4, 0.2))


def phrase_tables(spark, d):
    """A pivot dictionary from the corpus: two words of neighbouring rank share a pivot word."""
    ranked = materialize(rank_tokens(token_counts(tokenize(_docs(spark, d), lower=True))), "ranks")
    pivot = F.concat(F.lit("pv_"), F.floor(F.col("rank") / 2).cast("string")).alias("pivot")
    return ranked.select(F.col("tok").alias("word"), pivot), ranked.filter("rank % 2 = 0").select(pivot, F.col("tok").alias("word"))


def c7_back_translation(spark, d):
    fwd, bwd = phrase_tables(spark, d)
    return _digest(T.back_translation(_docs(spark, d), probability=0.3, forward=fwd, backward=bwd))


QUERIES["c7_back_translation"] = c7_back_translation
SQL["c7_back_translation"] = f"""
WITH {TOKENS_CTE}, {VOCAB_CTE},
g AS (SELECT doc_id, ws FROM toks WHERE {gate_sql(42, 'back_translation', 'doc_id', 0.3)} AND len(ws) > 0),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM g),
f AS (SELECT tok AS word, 'pv_' || (rank // 2) AS pivot FROM vocab),
b AS (SELECT 'pv_' || (rank // 2) AS pivot, tok AS word FROM vocab WHERE rank % 2 = 0),
t AS (SELECT w.doc_id, w.pos, coalesce(f.pivot, w.word) AS pivot FROM w LEFT JOIN f ON f.word = w.word),
k AS (SELECT t.doc_id, t.pos, coalesce(b.word, t.pivot) AS word FROM t LEFT JOIN b ON b.pivot = t.pivot),
j AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(j.text, d.text)) AS text_md5 FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id
"""


def c8_contextual_insertion(spark, d):
    docs = _docs(spark, d)
    return _digest(T.contextual_insertion(docs, probability=0.3, bigrams=materialize(T.bigram_counts(docs), "bigrams")))


QUERIES["c8_contextual_insertion"] = c8_contextual_insertion
_op8 = "contextual_insertion"
SQL["c8_contextual_insertion"] = f"""
WITH {TOKENS_CTE},
bg AS (SELECT word, follower, count(*) AS n FROM (SELECT unnest(ws[1:len(ws) - 1]) AS word, unnest(ws[2:len(ws)]) AS follower
  FROM toks WHERE len(ws) > 1) GROUP BY ALL),
g AS (SELECT doc_id, ws, {randint_sql(u_sql(42, _op8, 'doc_id', 0), '1', 'len(ws) - 1')} AS spot FROM toks
  WHERE {gate_sql(42, _op8, 'doc_id', 0.3)} AND len(ws) >= 3),
s AS (SELECT *, ws[spot] AS lw, ws[spot + 1] AS rw FROM g),
af AS (SELECT word, follower FROM bg QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, follower) <= 5),
ah AS (SELECT word, follower FROM bg QUALIFY row_number() OVER (PARTITION BY follower ORDER BY n DESC, word) <= 5),
c AS (SELECT s.doc_id, s.lw, s.rw, af.follower AS cand FROM s JOIN af ON af.word = s.lw
  UNION SELECT s.doc_id, s.lw, s.rw, ah.word FROM s JOIN ah ON ah.follower = s.rw),
q AS (SELECT c.doc_id, c.cand, (1 + coalesce(l.n, 0)) * (1 + coalesce(r.n, 0)) AS score FROM c
  LEFT JOIN bg l ON l.word = c.lw AND l.follower = c.cand LEFT JOIN bg r ON r.word = c.cand AND r.follower = c.rw),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cand) AS rn FROM q),
o5 AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS m FROM o WHERE rn <= 5),
e AS (SELECT doc_id, cand FROM o5 WHERE rn - 1 = {pick_sql(u_sql(42, _op8, 'doc_id', 1), 'm')}),
j AS (SELECT s.doc_id, array_to_string(list_concat(list_concat(ws[1:spot], [e.cand]), ws[spot + 1:len(ws)]), ' ') AS text FROM s JOIN e USING (doc_id))
SELECT d.doc_id, md5(coalesce(j.text, d.text)) AS text_md5 FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id
"""

COLUMN_CONFIG = {
    "pipeline": {
        "enabled": True,
        "text_augmentations": [
            {"name": "random_deletion", "enabled": True, "probability": 0.3},
            {"name": "back_translation", "enabled": False, "probability": 0.5},
            {"name": "token_cutoff", "enabled": True, "probability": 0.3, "cutoff_ratio": 0.1},
            {"name": "random_swap", "enabled": True, "probability": 0.3},
        ],
    }
}


def augmented(spark, d):
    return T.TextAugmenter(COLUMN_CONFIG).apply(_docs(spark, d))


_s1 = deletion_sql("documents", "0.random_deletion", 0.3, 0.3)
_s2 = cutoff_sql(_s1, "1.token_cutoff", 0.3, 0.1)
AUGMENTED_SQL = swap_sql(_s2, "2.random_swap", 0.3)


def c9_text_augmentation(spark, d):
    return _digest(augmented(spark, d))


QUERIES["c9_text_augmentation"] = c9_text_augmentation
SQL["c9_text_augmentation"] = _rows(AUGMENTED_SQL)


def c9_text_augmentation_lookup(spark, d):
    """A chain that mixes dictionary operators with operators on the row alone."""
    cfg = {
        "pipeline": {
            "enabled": True,
            "text_augmentations": [
                {"name": "synonym_replacement", "enabled": True, "probability": 0.2, "max_replacements": 1},
                {"name": "random_swap", "enabled": True, "probability": 0.3},
                {"name": "unknown_operator", "enabled": True, "probability": 0.3},
            ],
        }
    }
    return _digest(T.TextAugmenter(cfg, lexicon=stored_lexicon(spark, d)).apply(_docs(spark, d)))


QUERIES["c9_text_augmentation_lookup"] = c9_text_augmentation_lookup
_opc = "0.synonym_replacement"
_syn1 = f"""(SELECT s.doc_id, CASE WHEN NOT on_ OR len(ws) < 2 THEN s.text ELSE array_to_string(list_transform(ws, lambda w, i:
    CASE WHEN i = spot + 1 THEN coalesce(lex.syn, w) ELSE w END), ' ') END AS text
  FROM (SELECT doc_id, text, on_, ws, list_min(list_transform(ws, lambda w, i: {{'u': {u_sql(42, _opc, 'doc_id', 'i - 1')}, 'i': i - 1}})).i AS spot
    FROM (SELECT doc_id, text, {gate_sql(42, _opc, 'doc_id', 0.2)} AS on_, {words_sql('text')} AS ws FROM documents)) s
  LEFT JOIN lex ON lex.word = s.ws[spot + 1])"""
SQL["c9_text_augmentation_lookup"] = f"WITH {LEXICON_CTE} " + _rows(swap_sql(_syn1, "1.random_swap", 0.3))
