import json
import struct

import pytest
from pyspark.sql import functions as F

from trialweave.operators import mixing as X
from trialweave.operators import prepare as P
from trialweave.sources import corpus as C
from trialweave.sources import trials as ST


def test_packing_against_a_plain_loop(spark):
    docs = [(i * 3, list(range(i % 7))) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id bigint, input_ids array<int>")
    flat = [t for _, ids in docs for t in ids]
    want = [flat[i : i + 10] for i in range(0, len(flat) // 10 * 10, 10)]
    got = P.pack_sequences(df, 10, cell=5).orderBy("block_id").collect()
    assert [r.block_id for r in got] == list(range(len(want))) and [r.input_ids for r in got] == want
    assert P.pack_sequences(df, 10000).count() == 0


def test_one_long_row_fills_many_blocks(spark):
    df = spark.createDataFrame([(0, list(range(1003)))], "doc_id bigint, input_ids array<int>")
    got = P.pack_sequences(df, 100).orderBy("block_id").collect()
    assert len(got) == 10 and got[9].input_ids == list(range(900, 1000))


def test_vocabulary_and_encoding(spark):
    d = P.tokenize(spark.createDataFrame([(0, "b a b"), (1, "c a b zz"), (2, "")], "doc_id bigint, text string"))
    vocab = {r.tok: r.id for r in P.build_vocab(d, max_size=3).collect()}
    assert vocab == {"b": 2, "a": 3, "c": 4}
    enc = {r.doc_id: r.input_ids for r in P.encode(d, P.build_vocab(d, max_size=3)).collect()}
    assert enc == {0: [2, 3, 2], 1: [4, 3, 2, 1], 2: []}  # a text without tokens is kept


def test_padding(spark):
    df = spark.createDataFrame([(0, [5, 6]), (1, [5, 6, 7, 8, 9])], "doc_id int, input_ids array<int>")
    r = P.lm_labels(P.truncate_pad(df, 4), mask_pads=True).orderBy("doc_id").collect()
    assert (r[0].input_ids, r[0].attention_mask, r[0].special_tokens_mask, r[0].labels) == ([5, 6, 0, 0], [1, 1, 0, 0], [0, 0, 1, 1], [5, 6, -100, -100])
    assert r[1].input_ids == [5, 6, 7, 8]


@pytest.mark.parametrize("n", [0, 1, 10, 99])
def test_exact_split_sizes(spark, n):
    got = P.exact_split(spark.range(n), "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got}.get("train", 0) == int(0.9 * n)
    assert sum(r["count"] for r in got) == n


def test_batches(spark):
    ids = spark.range(100).withColumn("id", F.col("id") * 7)
    train = P.assign_batches(ids, "id", 8).groupBy("batch_id").count().collect()
    assert len(train) == 12 and {r["count"] for r in train} == {8}
    ev = P.assign_batches(ids, "id", 16, shuffle=False, drop_last=False)
    assert sorted(r["count"] for r in ev.groupBy("batch_id").count().collect()) == [4] + [16] * 6
    assert [r.batch_id for r in ev.orderBy("id").collect()] == [i // 16 for i in range(100)]


def test_unknown_task(spark):
    with pytest.raises(ValueError):
        P.prepare("speech", spark.range(1))


def test_split_aliases(spark):
    names = ["train", "dev", "valid", "validation", "test", "extra"]
    got = C.resolve_splits(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, split string"))
    assert sorted((r.id, r["split"]) for r in got.collect()) == [(0, "train"), (3, "validation"), (4, "test")]
    got = C.resolve_splits(spark.createDataFrame([(1, "dev"), (2, "train")], "id int, split string"))
    assert sorted((r.id, r["split"]) for r in got.collect()) == [(1, "validation"), (2, "train")]


def bitmap(path, rows):
    """A 24-bit BMP; rows of (r, g, b), top row first."""
    h, w = len(rows), len(rows[0])
    pad = b"\0" * (-w * 3 % 4)
    body = b"".join(b"".join(bytes((b, g, r)) for r, g, b in row) + pad for row in reversed(rows))
    head = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(head + body)


def test_image_files(spark, tmp_path):
    bitmap(tmp_path / "cat" / "a.bmp", [[(1, 2, 3), (4, 5, 6)], [(7, 8, 9), (10, 11, 12)]])
    r = C.read_images(spark, str(tmp_path), fmt="image").first()
    assert (r.channels, r.height, r.width, r.label) == (3, 2, 2, "cat")
    assert r.pixels == [1, 4, 7, 10, 2, 5, 8, 11, 3, 6, 9, 12]
    with pytest.raises(ValueError):
        C.read_images(spark, str(tmp_path), name="mnist")


def test_resize_and_standardize(spark):
    df = spark.createDataFrame([(0, [float(i) for i in range(16)])], "id int, pixels array<double>")
    assert P.resize(df, 2, 4, 4).first().pixels == [0.0, 2.0, 8.0, 10.0]
    assert P.resize(df, 4, 4, 4, method="bilinear").first().pixels == [float(i) for i in range(16)]
    big = P.resize(df, 8, 4, 4, method="bilinear").first().pixels
    assert len(big) == 64 and big[0] == 0.0 and big[63] == 15.0 and big[1] == pytest.approx(0.25)
    three = spark.createDataFrame([(0, [255.0, 0.0, 255.0])], "id int, pixels array<double>")
    got = P.standardize_channels(three, 1, scale=255.0).first().pixels
    assert got == pytest.approx([(v - m) / s for v, m, s in zip([1, 0, 1], P.CHANNEL_MEAN, P.CHANNEL_STD)])


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('text,label\n"a, ""b""",1\nplain,0\n')
    assert sorted((r.text, r.label) for r in C.read_labelled(spark, str(tmp_path)).collect()) == [('a, "b"', 1), ("plain", 0)]


def test_payloads(spark):
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><summary> one &amp; </summary></entry><entry/><entry><summary>two</summary></entry></feed>'
    long = "x" * 51
    pages = json.dumps({"query": {"pages": {"9": {"extract": "short"}, "1": {"title": "t"}, "5": {"extract": long}, "6": {"extract": long + "y"}}}})
    df = spark.createDataFrame([(0, feed, pages), (1, "<feed xmlns='http://www.w3.org/2005/Atom'/>", '{"query":{}}')], "id int, f string, p string")
    assert [r.text for r in C.extract_payloads(df, "id", "f", "arxiv").collect()] == ["one &", "two"]
    assert [r.text for r in C.extract_payloads(df, "id", "p", "wikipedia").collect()] == [long]


def test_run_log_files(spark, tmp_path):
    log = {
        "name": "r1", "config": {"a": 1}, "tags": {"t": "x"}, "metrics": [{"step": 1, "loss": 0.5}, {"step": 2, "loss": 0.4, "acc": 1.0}],
        "artifacts": [{"path": "p", "type": "model"}], "started_at": "2024-01-01T00:00:00", "accepted": True, "reason": "ok",
    }
    (tmp_path / "r1.json").write_text(json.dumps(log, indent=2))
    logs = ST.read_run_logs(spark, str(tmp_path), multi_line=True)
    r = logs.first()
    assert (r.name, json.loads(r.config), r.tags, r.accepted) == ("r1", {"a": 1}, {"t": "x"}, True)
    assert sorted(map(tuple, ST.metric_rows(logs).collect())) == [("r1", 1, "loss", 0.5), ("r1", 2, "acc", 1.0), ("r1", 2, "loss", 0.4)]
    assert [tuple(x) for x in ST.artifact_rows(logs).collect()] == [("r1", "p", "model")]


def test_mixing(spark):
    make = lambda n, t: spark.range(n).select("id", F.concat(F.lit(t), F.col("id").cast("string")).alias("text"))
    base, ext = make(40, "b"), make(30, "mail x@y.org ")
    out = X.mix_external(base, [ext], 0.25)
    assert out.filter("origin = 'base'").count() == 40
    added = out.filter("origin <> 'base'").collect()
    assert len(added) == 10 and all(r.pii_count == 1 for r in added)
    assert X.mix_external(base, [ext], 0.0).count() == 40 and X.mix_external(base, [make(3, "e")], 0.5).count() == 43
    with pytest.raises(ValueError):
        X.mix_external(base, [ext], 0.6)
    with pytest.raises(ValueError):
        X.mix_external(base, [ext] * 6, 0.1)
    got = X.fetch_union({"a": base, "b": ext}, ["b", "nowhere", "a"], max_results=35).collect()
    assert [r.source for r in got] == ["b"] * 30 + ["a"] * 5


def test_labelled_csv_goes_by_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,label,text\n7,1,"one, two"\n8,x,three\n')
    assert sorted((r.text, r.label) for r in C.read_labelled(spark, str(tmp_path)).collect()) == [("one, two", 1), ("three", None)]


def test_texts_without_tokens_are_encoded(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, " "), (3, None), (4, "c")], "doc_id bigint, text string")
    tokens = P.tokenize(df)
    got = {r.doc_id: r.input_ids for r in P.encode(tokens, P.build_vocab(tokens)).collect()}
    assert got == {1: [2, 3, 2], 2: [], 3: [], 4: [4]}
    labelled = df.withColumn("label", F.lit(1))
    rows = P.prepare("text_classification", labelled, max_length=4).collect()
    assert len(rows) == 4 and {tuple(r.input_ids) for r in rows if r.doc_id in (2, 3)} == {(0, 0, 0, 0)}


def test_paragraphs_with_attributes(spark):
    html = '<p class="x">' + "a &lt; b &amp;amp; " * 5 + "</p><pre>no</pre><P>no</P><p>two</p>"
    df = spark.createDataFrame([(1, html)], "id bigint, payload string")
    assert C.extract_payloads(df, "id", "payload", "html").first().text == ("a < b &amp; " * 5).strip() + "\ntwo"


def test_packing_by_sparse_and_text_keys(spark):
    rows = [(hash((i, "x")) % (1 << 60), list(range(i % 5))) for i in range(120)]
    for kind, keys in (("bigint", [k for k, _ in rows]), ("string", [str(k) for k, _ in rows])):
        df = spark.createDataFrame([(k, ids) for k, (_, ids) in zip(keys, rows)], f"doc_id {kind}, input_ids array<int>")
        flat = [t for _, ids in sorted(zip(keys, (ids for _, ids in rows))) for t in ids]
        got = P.pack_sequences(df, 8, cell=16).orderBy("block_id").collect()
        assert [r.input_ids for r in got] == [flat[i : i + 8] for i in range(0, len(flat) // 8 * 8, 8)]
        order = {r.doc_id: r.batch_id for r in P.assign_batches(df, "doc_id", size=7, shuffle=False, drop_last=False).collect()}
        assert [order[k] for k in sorted(keys)] == [i // 7 for i in range(120)]


def test_broken_feeds_are_passed_over(spark):
    good = "<feed><entry><summary> a &lt; b </summary></entry></feed>"
    df = spark.createDataFrame([(0, "<feed><entry><summary>x</summary>"), (1, "no xml"), (2, None), (3, good)], "id int, payload string")
    assert [tuple(r) for r in C.extract_payloads(df, "id", "payload", "arxiv").collect()] == [(3, "a < b")]


def test_ranks_of_tokens_that_begin_alike(spark):
    counts = spark.createDataFrame([(f"http{i:04d}", 1) for i in range(500)] + [("the", 9)], "tok string, cnt bigint")
    got = {r.tok: r["rank"] for r in P.rank_tokens(counts).collect()}
    assert got["the"] == 0 and [got[f"http{i:04d}"] for i in range(500)] == list(range(1, 501))
