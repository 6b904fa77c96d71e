"""WARC transactions, the vector index and the pipeline."""

import gzip
import hashlib

import numpy as np
from pyspark.sql import functions as F

from trialweave.llm import components, multi_index, warc
from trialweave.plans.session import fresh_path


def capture(spark, rows, **names):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_id string")
    path = fresh_path(spark, "warc-test")
    warc.write_archive(pages, path, **names)
    return path


def test_round_trip(spark):
    big = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nä" * 40
    rows = [(3, "http://a", big), (1, None, big), (2, "http://b\nx", "small"), (4, "u", "small"), (None, "n", big), (5, "e", None), (6, "e", ""), (1, None, big), (7, "l", "y" * 900_000)]
    path = capture(spark, [(*r, "clash") for r in rows], records_per_file=5)
    out = warc.resolved(warc.transactions(warc.read_records(spark, path))).collect()
    assert len(out) == len(rows)
    found = sorted(
        (dict(r["metadata"]["fields"]).get("page-id", ""), r["response"]["warc_type"], r["held"]["page_id"] if r["held"] else "", len(r["response"]["payload"] or b""))
        for r in out
    )
    holders = {r["capture_id"] for r in out if r["response"]["warc_type"] == "response"}
    assert all((r["response"]["refers_to"] in holders) == (r["response"]["warc_type"] == "revisit") for r in out)
    n = len(big.encode())
    assert found == [("", "revisit", "1", 0), ("1", "response", "", n), ("1", "response", "", n), ("2", "response", "", 5), ("3", "revisit", "1", 0), ("4", "response", "", 5), ("5", "response", "", 0), ("6", "response", "", 0), ("7", "response", "", 900_000)]
    assert {r["response"]["payload_digest"] for r in out} == {hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in rows}
    assert all(r["request"]["record_id"] for r in out)


def test_foreign_archives():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 25\r\n\r\nHTTP/1.1 404 No\r\nA: b\r\n\r\nhi\r\n\r\n"
    record = record.replace(b"25", str(len(b"HTTP/1.1 404 No\r\nA: b\r\n\r\nhi")).encode())
    for data in (record * 2, gzip.compress(record) * 2, record * 2 + record[:30]):
        found = list(warc.parse_archive(data))
        assert [(f[0], f[6], f[7], f[9]) for f in found] == [("<x>", 2, 404, b"hi")] * 2


def test_malformed_records():
    good = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 13\r\n\r\nHTTP/1.1 \r\n\r\n\r\n\r\n"
    odd = [good.replace(b"13", n) for n in (b"x", b"-5", b"1e3", "\u0661".encode(), b"", b"9" * 40)]
    short = [good.replace(b"HTTP/1.1 ", b"HTTP/1.1x"), good.replace(b"HTTP/1.1 ", b"HTTP/1 ab"), good.replace(b"HTTP/1.1 ", b"\xff\xfe\x00 1 22")]
    for bad in odd:
        assert [f[0] for f in warc.parse_archive(bad + good)] == ["<x>"]
    for bad in (good, *short):
        assert [(f[0], f[7]) for f in warc.parse_archive(bad + good)] == [("<x>", None)] * 2
    assert list(warc.parse_archive(gzip.compress(good)[:-30] + b"\x1f\x8bxxxxxxxxxxxxxxx")) is not None
    assert list(warc.parse_archive(b"\x1f\x8bnot gzip")) == []


def test_no_pages(spark):
    path = capture(spark, [])
    assert warc.transactions(warc.read_records(spark, path)).count() == 0


def brute_nearest(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float64)
    out = []
    for q in ok:
        if q % 20 == 0:
            near = sorted((-np.cumsum(ok[q] * ok[c])[-1], c) for c in ok if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(near)]
    return sorted(out)


def vectors(rng, n):
    rows = [(k, [float(x) for x in np.float32(rng.normal(size=8))]) for k in range(n)]
    rows[7] = (7, None)
    rows[8] = (8, [0.0] * 8)
    rows[9] = (9, [1.0] * 7 + [None])
    rows[10] = (10, [float("nan")] + [1.0] * 7)
    rows[11] = (11, [1.0] * 5)
    for k in range(20, 90):
        rows[k] = (k, rows[19][1])  # many equal vectors
    return [*rows, (None, rows[1][1]), rows[3], rows[40]]


def test_nearest_is_exact_within_reach(spark):
    rows = vectors(np.random.default_rng(1), 260)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, key string")
    got = sorted(map(tuple, multi_index.nearest(df, F.col("id") % 20 == 0, k=20).collect()))
    assert got == brute_nearest(rows, 20)


def test_recall_with_a_short_reach(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.25 * rng.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest(df, F.col("id") % 20 == 0, k=10, reach=800, share=0.2).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 4000, 20):
        s = x @ x[q]
        s[q] = -9
        hits += len(got[q] & set(np.argsort(-s)[:10].tolist()))
    assert hits >= 0.9 * 10 * 200


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert multi_index.nearest(df, F.col("id") % 20 == 0).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), *[(k, k + 1) for k in range(100, 160)], (20, 200), (200, 30), (30, 21)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 200: 20, 30: 20, 21: 20} | {k: 100 for k in range(100, 161)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, odd, none, tmp_path):
    import corpus_pipeline as pipeline

    docs = odd
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == pipeline.COLUMNS, name
        path = fresh_path(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    pieces = pipeline.STAGES[-1][1](spark, docs, "")
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}
    empty = none.select(*pipeline.COLUMNS)
    for _, stage in pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0
