"""Removes stretches of lines that are already there earlier in the corpus.

A *repeat* is a stretch of consecutive lines with a word, of at least ``RUN`` lines or with more than ``WORDS`` words, that is equal to one which begins earlier, by (id, position). All lines
of repeats are deleted. Every repeat is the union of repeats of ``RUN`` lines, or it is one of fewer lines; so these *runs* are what has to be found:

1. *Winnowing.* Lines are hashed. The smallest hash (the first of equal ones) of every ``RUN`` consecutive lines is a fingerprint, so each run of ``RUN`` lines has one, at the
   same place as in every equal run. A run of fewer lines has a line with more than ``WORDS // (RUN - 1)`` words; such lines are always fingerprints.
   Only fingerprints are kept, each with the hashes of the ``RUN - 1`` lines on either side.
2. *Positions.* Fingerprints at one position only are dropped. The others are joined with the first position that has the same fingerprint and the same lines around it,
   for each run of lines around it that is long enough: the match is extended to both sides as far as a run goes.
   First positions are partial minima, so a line that a third of all documents share costs one row per task, and pairs of positions are never listed.
3. *Deletion.* Runs behind their first position are united in their documents; where they overlap or meet they are one longer match.

Runs are told apart by the fingerprint's 64 bits and 64 more of the lines around it, runs of one line by 64 bits.

Defined results: a null text is empty; lines without a word are kept and don't interrupt a stretch; stretches may overlap themselves in one document (the first stays); null ids come
before others; rows equal in id and text are one document and keep their lines alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import batches_of, join_text, keyed, materialize, read, schema_with

RUN, WORDS = 3, 50
_BLANK = " \t\n\x0b\x0c\r"


def worded_lines(text: str) -> tuple[list[str], list[int]]:
    """All lines, and the places of those with a word."""
    lines = text.split("\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(_BLANK)]


def fingerprints(lines: list[str], run: int, words: int) -> Iterator[tuple[int, int, list[int | None], list[int]]]:
    """(hash, place, hashes of the lines around, runs shorter than ``run`` with enough words) of each fingerprint.

    The lines around are those from ``run - 1`` before to ``run - 1`` after, None where there is none. A short run is its first line's distance before the fingerprint times ``run``, plus its lines.
    """
    data = [x.encode("utf-8", "surrogatepass") for x in lines]
    hashes = [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in data]
    sizes = [len(x.split()) for x in data]
    n = len(lines)
    chosen = {min(range(i, i + run), key=hashes.__getitem__) for i in range(n - run + 1)}
    chosen.update(i for i in range(n) if sizes[i] > words // (run - 1))
    for i in sorted(chosen):
        around = [hashes[k] if 0 <= k < n else None for k in range(i - run + 1, i + run)]
        short = [
            before * run + size
            for size in range(1, run)
            for before in range(size)
            if i >= before and i - before + size <= n and sum(sizes[i - before : i - before + size]) > words
        ]
        yield hashes[i], i, around, short


def repeated_runs(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """``_id``, ``_h``, ``start`` (among lines with a word) and ``size`` of the later ones of equal runs."""
    schema = pa.schema([("row", pa.int64()), ("fp", pa.int64()), ("at", pa.int64()), ("around", pa.list_(pa.int64())), ("short", pa.list_(pa.int64()))])
    id_type = docs.schema["_id"].dataType.simpleString()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:

            def rows(texts=batch.column("_text")):
                for i in range(len(texts)):
                    lines, places = worded_lines(texts[i].as_py())
                    for found in fingerprints([lines[p] for p in places], run, words):
                        yield i, *found

            for out in batches_of(rows(), schema):
                take = out.column("row")
                yield pa.RecordBatch.from_arrays([batch.column("_id").take(take), batch.column("_h").take(take), *out.columns[1:]], names=["_id", "_h", *schema.names[1:]])

    found = docs.select("_id", "_h", "_text").mapInArrow(pick, f"_id {id_type}, _h long, fp long, at long, around array<bigint>, short array<bigint>")
    found = materialize(found, "line-fingerprints")
    shared = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp")
    found = found.join(shared, "fp", "left_semi")
    shapes = []
    for size in range(1, run + 1):
        for before in range(size):
            lines = [F.col("around")[run - 1 - before + k] for k in range(size)]
            there = F.forall(F.array(lines[0], lines[-1]), lambda h: h.isNotNull()) if size == run else F.array_contains("short", before * run + size)
            shapes.append(F.when(there, F.struct(F.lit(before).alias("before"), F.lit(size).alias("size"), F.xxhash64(*lines).alias("lines"))))
    runs = found.select("_id", "_h", "fp", "at", F.explode(F.array_compact(F.array(*shapes))).alias("s"))
    runs = runs.select("fp", "s.*", F.struct("_id", "_h", "at").alias("place"))
    key = ["fp", "before", "size", "lines"]
    firsts = runs.groupBy(*key).agg(F.min("place").alias("origin"), F.max("place").alias("latest"))
    firsts = firsts.filter(F.col("origin") < F.col("latest")).drop("latest")
    later = runs.join(firsts, key).filter(F.col("place") > F.col("origin"))
    return later.select("place._id", "place._h", (F.col("place.at") - F.col("before")).alias("start"), "size")


def remove_runs(text: str, runs: list[dict]) -> tuple[str, int, int, int]:
    """The text without the runs, its number of lines, of removed lines and of maximal removed stretches."""
    lines, places = worded_lines(text)
    gone = sorted({i for r in runs for i in range(r["start"], r["start"] + r["size"])})
    drop = {places[i] for i in gone}
    stretches = sum(1 for i, x in enumerate(gone) if not i or gone[i - 1] != x - 1)
    return "\n".join(x for i, x in enumerate(lines) if i not in drop), len(lines), len(drop), stretches


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, run: int = RUN, words: int = WORDS
) -> DataFrame:
    """Per row: its ``id``, the columns of ``keep`` as a struct, the ``text`` left, ``n_lines``, ``n_removed`` and ``n_runs``."""
    own = keyed(docs, id_col, text_col, keep)
    runs = repeated_runs(own, run, words).groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "size")).alias("runs"))
    passed = {"_id": "id", "_keep": "keep"} if keep else {"_id": "id"}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [remove_runs(t.as_py(), r.as_py() or []) for t, r in zip(batch.column("_text"), batch.column("runs"))]
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                names=[*passed.values(), "text", "n_lines", "n_removed", "n_runs"],
            )

    joined = join_text(own, runs).select(*passed, "_text", "runs")
    return joined.mapInArrow(cut, schema_with(own, passed, "text string, n_lines long, n_removed long, n_runs long"))


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup(read(spark, folder, "documents", "doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS no FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
r AS (SELECT doc_id, pos, k, string_agg(line, chr(10)) OVER f AS run, count(*) OVER f AS n, sum(words) OVER f AS words FROM w, generate_series(1, {RUN}) AS g(k)
 WINDOW f AS (PARTITION BY doc_id, k ORDER BY pos ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING)),
later AS (SELECT doc_id, pos, k FROM (SELECT *, row_number() OVER (PARTITION BY k, run ORDER BY doc_id, pos) AS nth FROM r WHERE n = k AND (k = {RUN} OR words > {WORDS})) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, pos + d AS pos FROM later, generate_series(0, {RUN - 1}) AS g(d) WHERE d < k),
m AS (SELECT l.doc_id, l.no, l.line, w.pos, gone.pos IS NOT NULL AS dropped FROM l LEFT JOIN w USING (doc_id, no) LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.pos = w.pos),
s AS (SELECT doc_id, count(*) AS n FROM gone g WHERE NOT EXISTS (FROM gone h WHERE h.doc_id = g.doc_id AND h.pos = g.pos - 1) GROUP BY doc_id)
SELECT m.doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_removed, coalesce(any_value(s.n), 0)::BIGINT AS n_runs,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT dropped), '')) AS kept_sha256
FROM m LEFT JOIN s USING (doc_id) GROUP BY m.doc_id
"""
QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES = {"op1_line_dedup": SQL}
