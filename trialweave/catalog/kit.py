"""Small helpers to state registered queries: table access and the SQL twins of shared expressions."""

from __future__ import annotations

from ..functions.texts import BLANKS


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def u_sql(seed: int, op: str, key: str, i) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', '{op}', {key}, {i})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def gate_sql(seed: int, op: str, key: str, p: float) -> str:
    return f"({u_sql(seed, op + ':gate', key, 0)} < {p}::DOUBLE)"


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {sql_str(BLANKS)}), lambda w: w <> '')"


def pick_sql(draw: str, n: str) -> str:
    return f"floor({draw} * ({n}))::BIGINT"


def randint_sql(draw: str, low: str, high: str) -> str:
    return f"(({low}) + floor({draw} * (({high}) - ({low}) + 1)))::BIGINT"


# words per document, by position, and the lower-cased vocabulary with its ranks
TOKENS_CTE = f"toks AS (SELECT doc_id, {words_sql('text')} AS ws FROM documents)"
VOCAB_CTE = (
    f"lowered AS (SELECT unnest({words_sql('lower(text)')}) AS tok FROM documents), "
    "vocab AS (SELECT tok, count(*)::BIGINT AS cnt, row_number() OVER (ORDER BY count(*) DESC, tok) - 1 AS rank "
    "FROM lowered GROUP BY tok)"
)
