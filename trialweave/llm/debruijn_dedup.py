"""Removes words of windows that a document with a smaller id has as well, by compaction of a De Bruijn graph of words.

A window of ``window`` words is an edge from the node of its first ``window - 1`` words to that of its last ones; two 64-bit hashes, one of each node, name an edge.

1. *Spots.* Windows that share their anchor (``word_strings``) come as one row; spots whose anchor no other document has are done, and spots of one anchor and
   context are one context, held by the document with the smallest id. A thousand copies of a text leave its contexts once, after partial grouping.
2. *Edges.* An anchor with one context needs no graph: all its windows are the holder's. The contexts of other anchors are cut into edges; grouping them gives every edge
   its source, the smallest (id, place) that has it.
3. *Compaction.* Nodes with one repeated edge in and one out do not branch. Edges are joined with the edge that follows at such a node if the source goes on there too; edges so linked
   are one path, a stretch of its source. Contexts then hold a few pieces of paths instead of edges.
4. *Verification.* Pieces return to the spots of their contexts, and pieces that follow each other in the document and in the source are joined to spans. The source's text
   at those coordinates is hashed as a whole, and a span is cut only where the document's own words have that hash (counted in ``n_unverified`` otherwise, which takes two
   pairs of equal 64-bit hashes of different words).

Defined results: a null text has no words; documents shorter than a window lose nothing; a null id is smaller than all others; rows with equal ids are one document to this rule, so
they keep what only they have in common; a window that overlaps its earlier place in the same document is no repeat; tables without rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import batches_of, discard, join_text, keyed, materialize, read, schema_with
from .suffix_dedup import Hasher
from .word_strings import PIECE, find_spots, mixed, symbols

WINDOW, GRAM = 13, 5
_SPAN = "struct<start:bigint,n:bigint,hid:{id},hh:bigint,hpos:bigint>"


def before(a: Column, b: Column) -> Column:
    """Order of ids, null first."""
    return (a < b) | (a.isNull() & b.isNotNull())


def _edges(asked: DataFrame, window: int) -> DataFrame:
    """``src``, ``dst`` (nodes), ``_id``, ``_h``, ``pos``, ``cid``, ``off`` of every window of the contexts asked for."""
    id_type = asked.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE)
        for batch in batches:
            for i, (text, wanted) in enumerate(zip(batch.column("_text").cast(pa.binary()), batch.column("asked"))):
                nodes = node_names(symbols(text.as_py()), hasher, window - 1)
                first, last, cids = (wanted.values.field(c).to_numpy() for c in ("a", "b", "cid"))
                for k in range(0, len(first), 5000):
                    sizes = last[k : k + 5000] - first[k : k + 5000] + 1
                    off = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    pos = np.repeat(first[k : k + 5000], sizes) + off
                    cid = np.repeat(cids[k : k + 5000], sizes)
                    owner = pa.array(np.full(len(pos), i))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[pos]), pa.array(nodes[pos + 1]), batch.column("_id").take(owner), batch.column("_h").take(owner), pa.array(pos), pa.array(cid), pa.array(off)],
                        names=["src", "dst", "_id", "_h", "pos", "cid", "off"],
                    )

    return asked.select("_id", "_h", "_text", "asked").mapInArrow(cut, f"src long, dst long, _id {id_type}, _h long, pos long, cid long, off long")


def node_names(sym: np.ndarray, hasher: Hasher, size: int) -> np.ndarray:
    """The hashes of all strings of ``size`` words, of texts of any length."""
    step = PIECE - size
    parts = [mixed(hasher.grams(sym[k : k + step + size - 1], size)) for k in range(0, max(len(sym) - size + 1, 0), step)]
    return np.concatenate(parts or [np.empty(0, np.uint64)]).view(np.int64)


def sources(edges: DataFrame) -> DataFrame:
    """Per edge (``src``, ``dst``) of ``edges`` (which has one row for each context it is in): its source ``hid``, ``hh``, ``hpos``, the smallest ``_id``, ``_h``, ``pos``."""
    found = edges.groupBy("src", "dst").agg(F.min(F.struct("_id", "_h", "pos")).alias("at"))
    return found.select("src", "dst", F.col("at._id").alias("hid"), F.col("at._h").alias("hh"), F.col("at.pos").alias("hpos"))


def compacted(found: DataFrame) -> DataFrame:
    """Edges with their sources and ``path``, the place in the source where an edge's nonbranching path begins."""
    ins = found.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.max(F.struct("hid", "hh", "hpos")).alias("last"))
    outs = found.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    plain = ins.filter("n_in = 1").join(outs.filter("n_out = 1"), "node").select("node", "last")
    follows = found.join(plain.select(F.col("node").alias("src"), "last"), "src", "left")
    same = F.col("last.hid").eqNullSafe(F.col("hid")) & (F.col("last.hh") == F.col("hh")) & (F.col("last.hpos") == F.col("hpos") - 1)
    follows = follows.withColumn("head", F.when(~F.coalesce(same, F.lit(False)), F.col("hpos")))
    w = W.partitionBy("hid", "hh").orderBy("hpos").rowsBetween(W.unboundedPreceding, 0)
    return follows.select("src", "dst", "hid", "hh", "hpos", F.max("head").over(w).alias("path"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a document that go on in the document and in the source become one span."""
    for batch in batches:
        column = batch.column("pieces")
        flat = column.flatten()
        if not len(flat):
            continue
        start, n, hh, hpos = (flat.field(c).to_numpy() for c in ("start", "n", "hh", "hpos"))
        hid = flat.field("hid")
        name = pc.fill_null(hid.dictionary_encode().indices, -1).to_numpy()
        doc = np.repeat(np.arange(len(column)), pc.list_value_length(column).to_numpy())
        order = np.lexsort((start, start - hpos, hh, name, doc))
        doc, start, end, name, hh, hpos = doc[order], start[order], (start + n)[order], name[order], hh[order], hpos[order]
        along = start - hpos
        new = np.ones(len(start), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1]) | (hh[1:] != hh[:-1]) | (along[1:] != along[:-1]) | (start[1:] > end[:-1])
        head = np.flatnonzero(new)
        length = np.maximum.reduceat(end, head) - start[head]
        sizes = np.bincount(doc[head], minlength=len(column))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        kind = batch.schema.field("pieces").type
        parts = [pa.array(start[head]), pa.array(length), hid.take(pa.array(order[head])), pa.array(hh[head]), pa.array(hpos[head])]
        spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, names=["start", "n", "hid", "hh", "hpos"]))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_h"), spans.cast(kind)], names=["_id", "_h", "spans"])


def repeated_spans(own: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per ``_id`` and ``_h``: ``spans``, stretches of windows (first start, number of starts) and where their source has them."""
    id_type = own.schema["_id"].dataType.simpleString()
    found = find_spots(own, window, gram).withColumns({"a": F.col("a").cast("int"), "b": F.col("b").cast("int")})
    # spots move once, by anchor; a spot is one of about a hundred of its document, so even an anchor that a third of all documents have is a small share of all
    w = W.partitionBy("anchor")
    found = found.withColumns({"low": F.min(F.struct("_id")).over(w), "high": F.max(F.struct("_id")).over(w)}).filter("low < high").drop("low", "high")
    found = materialize(found.withColumns({"a": F.col("a").cast("long"), "b": F.col("b").cast("long")}), "spots-shared")
    contexts = found.groupBy("anchor", "context").agg(F.min(F.struct("_id", "_h", "a", "b")).alias("rep"), F.max(F.struct("_id")).alias("last"))
    contexts = contexts.withColumn("kinds", F.count(F.lit(1)).over(w))
    contexts = materialize(contexts.withColumn("cid", F.monotonically_increasing_id()), "contexts")
    asked = contexts.filter("kinds > 1").select("rep.*", "cid").groupBy("_id", "_h").agg(F.collect_list(F.struct("a", "b", "cid")).alias("asked"))
    edges = materialize(_edges(join_text(own.select("_id", "_h", "_text"), asked, "inner"), window), "edges")
    held_by = materialize(sources(edges), "debruijn-edges")
    paths = materialize(compacted(held_by), "debruijn-paths")
    discard(held_by)
    in_paths = edges.select("src", "dst", "cid", "off").join(paths, ["src", "dst"])
    pieces = in_paths.groupBy("cid", "hid", "hh", "path", (F.col("hpos") - F.col("off")).alias("along")).agg(F.min("off").alias("lo"), F.max("off").alias("hi"), F.min("hpos").alias("hpos"))
    piece = F.struct("lo", "hi", "hid", "hh", "hpos")
    pieces = pieces.groupBy("cid").agg(F.collect_list(piece).alias("many"))
    one = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("rep.b") - F.col("rep.a")).alias("hi"), F.col("rep._id").alias("hid"), F.col("rep._h").alias("hh"), F.col("rep.a").alias("hpos")))
    held = contexts.join(pieces, "cid", "left").select("anchor", "context", "last", F.when(F.col("kinds") == 1, one).otherwise(F.col("many")).alias("many"))
    # a piece counts where some document with the context comes behind its source
    held = held.withColumn("many", F.filter("many", lambda x: before(x["hid"], F.col("last._id")))).filter(F.size("many") > 0).drop("last")
    held = materialize(held, "contexts-held")
    discard(edges, paths, contexts)
    back = found.drop("b").join(held, ["anchor", "context"])
    later = F.filter("many", lambda x: before(x["hid"], F.col("_id")))
    moved = F.transform(later, lambda x: F.struct((F.col("a") + x["lo"]).alias("start"), (x["hi"] - x["lo"] + 1).alias("n"), x["hid"].alias("hid"), x["hh"].alias("hh"), x["hpos"].alias("hpos")))
    back = back.select("_id", "_h", moved.alias("pieces")).filter(F.size("pieces") > 0)
    per_doc = back.groupBy("_id", "_h").agg(F.flatten(F.collect_list("pieces")).alias("pieces"))
    spans = materialize(per_doc.mapInArrow(_merged, f"_id {id_type}, _h long, spans array<{_SPAN.format(id=id_type)}>"), "debruijn-spans")
    discard(found, held)
    return spans


def _with_digests(own: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """Per ``_id`` and ``_h``: ``spans`` with the hash of the source's words there."""
    id_type = own.schema["_id"].dataType.simpleString()
    each = spans.select("_id", "_h", F.explode("spans").alias("s")).select("_id", "_h", "s.*")
    wanted = each.groupBy("hid", "hh").agg(F.collect_set(F.struct("hpos", "n")).alias("wanted")).select(F.col("hid").alias("_id"), F.col("hh").alias("_h"), "wanted")
    schema = pa.schema([("row", pa.int64()), ("hh", pa.int64()), ("hpos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch):
            for i, (text, h, asked) in enumerate(zip(batch.column("_text").cast(pa.binary()), batch.column("_h"), batch.column("wanted"))):
                words = text.as_py().split()
                for x in asked.as_py():
                    yield i, h.as_py(), x["hpos"], x["n"], words_digest(words, x["hpos"], x["n"], window)

        for batch in batches:
            for out in batches_of(rows(batch), schema):
                yield pa.RecordBatch.from_arrays([batch.column("_id").take(out.column("row")), *out.columns[1:]], names=["hid", *schema.names[1:]])

    seen = join_text(own.select("_id", "_h", "_text"), wanted, "inner").select("_id", "_h", "_text", "wanted").mapInArrow(look, f"hid {id_type}, hh long, hpos long, n long, digest binary")
    seen = materialize(seen, "debruijn-digests").dropDuplicates(["hid", "hh", "hpos", "n"])
    seen = seen.select(F.col("hid").alias("_sid"), F.col("hh").alias("_sh"), F.col("hpos").alias("_sp"), F.col("n").alias("_sn"), "digest")
    there = (F.col("hh") == F.col("_sh")) & (F.col("hpos") == F.col("_sp")) & (F.col("n") == F.col("_sn"))
    both = each.join(seen, F.col("hid").eqNullSafe(F.col("_sid")) & there)
    return both.groupBy("_id", "_h").agg(F.collect_list(F.struct("start", "n", "digest")).alias("spans"))


def words_digest(words: list[bytes], start: int, n: int, window: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[start : start + n + window - 1]))


def kept_words(words: list[bytes], spans: list[dict], window: int) -> tuple[list[bytes], int, int]:
    """The words left, the stretches removed, and how many spans the words did not bear out."""
    gone = np.zeros(len(words) + 1, np.int64)
    wrong = 0
    for s in spans:
        if words_digest(words, s["start"], s["n"], window) == s["digest"]:
            gone[s["start"]] += 1
            gone[s["start"] + s["n"] + window - 1] -= 1
        else:
            wrong += 1
    drop = np.cumsum(gone)[:-1] > 0
    stretches = int(np.count_nonzero(np.diff(np.concatenate([[0], drop.view(np.int8)])) == 1))
    return [words[i] for i in np.flatnonzero(~drop).tolist()], stretches, wrong


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: ``id``, the columns of ``keep`` as a struct, ``text`` (the words left, joined by blanks), ``n_words``, ``n_removed``, ``n_spans`` and ``n_unverified``."""
    own = keyed(docs, id_col, text_col, keep)
    spans = _with_digests(own, repeated_spans(own, window, gram), window)
    passed = {"_id": "id", "_keep": "keep"} if keep else {"_id": "id"}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, sizes, gone, stretches, wrong = [], [], [], [], []
            for text, found in zip(batch.column("_text").cast(pa.binary()), batch.column("spans")):
                words = text.as_py().split()
                kept, n, bad = kept_words(words, found.as_py() or [], window)
                left.append(b" ".join(kept))
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
                stretches.append(n)
                wrong.append(bad)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(left, pa.binary()).cast(pa.string()), *[pa.array(x, pa.int64()) for x in (sizes, gone, stretches, wrong)]],
                names=[*passed.values(), "text", "n_words", "n_removed", "n_spans", "n_unverified"],
            )

    joined = join_text(own, spans).select(*passed, "_text", "spans")
    return joined.mapInArrow(cut, schema_with(own, passed, "text string, n_words long, n_removed long, n_spans long, n_unverified long"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup(read(spark, folder, "documents", "doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS p, ws FROM w WHERE len(ws) >= {WINDOW}),
k AS (SELECT doc_id, p, list_slice(ws, p, p + {WINDOW - 1}) AS s FROM g),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM k),
gone AS (SELECT doc_id, list(p) AS ps FROM f WHERE low < doc_id GROUP BY doc_id),
m AS (SELECT w.doc_id, ws, list_distinct(flatten(list_transform(coalesce(ps, []), lambda p: range(p, p + {WINDOW})))) AS out FROM w LEFT JOIN gone USING (doc_id)),
x AS (SELECT doc_id, ws, out, unnest(generate_series(1, len(ws))) AS i FROM m WHERE len(ws) > 0),
l AS (SELECT x.doc_id, coalesce(string_agg(ws[i], ' ' ORDER BY i) FILTER (NOT list_contains(out, i)), '') AS kept FROM x GROUP BY x.doc_id)
SELECT m.doc_id, len(ws)::BIGINT AS n_words, len(out)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM m LEFT JOIN l USING (doc_id)
"""
QUERIES = {"op13_substring_dedup": op13_substring_dedup}
ORACLES = {"op13_substring_dedup": SQL}
