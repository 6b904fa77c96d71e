import numpy as np
from pyspark.sql import functions as F

from trialweave.operators import safety as S


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def found(df):
    return sorted((r.doc_id, r.type, round(r.score, 2), r.text) for r in df.collect())


def test_every_type(spark):
    texts = [
        "write to ann.lee@mail.example.com now",
        "call +1 (555) 123-4567 today",
        "ssn 078-05-1120.",
        "card 4539578763621486 and 4539578763621487",
        "host 192.168.0.1 not 300.1.1.1",
        "iban GB82WEST12345698765432 or GB82WEST12345698765431",
        "passport number A12345678",
        "number A12345678",
        "driver license D1234567",
        "no data at all",
    ]
    got = found(S.pii_scan(docs(spark, *texts)))
    assert got == [
        (0, "EMAIL_ADDRESS", 0.95, "ann.lee@mail.example.com"),
        (1, "PHONE_NUMBER", 0.75, "+1 (555) 123-4567"),
        (2, "US_SSN", 0.85, "078-05-1120"),
        (3, "CREDIT_CARD", 1.0, "4539578763621486"),
        (4, "IP_ADDRESS", 0.8, "192.168.0.1"),
        (5, "IBAN_CODE", 1.0, "GB82WEST12345698765432"),
        (6, "US_PASSPORT", 0.8, "A12345678"),
        (8, "US_DRIVER_LICENSE", 0.8, "D1234567"),
    ]
    low = found(S.pii_scan(docs(spark, *texts), threshold=0.0))
    assert (3, "CREDIT_CARD", 0.3, "4539578763621487") in low and (7, "US_PASSPORT", 0.3, "A12345678") in low
    assert not S.pii_scan(docs(spark, *texts), threshold=0.99).filter("type = 'EMAIL_ADDRESS'").count()


def test_offsets_cut_the_match_out(spark):
    texts = ["ü a@b.co and c@d.org, 10.0.0.1 e@f.net", "a@b.co", "x\n\ty a@b.co\n"]
    rows = S.pii_scan(docs(spark, *texts)).collect()
    assert len(rows) == 6 and all(texts[r.doc_id][r.start : r.end] == r.text for r in rows)


def test_persons(spark):
    names = spark.createDataFrame([("Ann", "Lee")], "given string, family string")
    texts = ["  Ann  Lee met Ann Lee", "Ann and Lee", "Lee Ann"]
    rows = S.pii_scan(docs(spark, *texts), gazetteer=names).collect()
    assert sorted((r.doc_id, r.start, r.text) for r in rows) == [(0, 2, "Ann  Lee"), (0, 15, "Ann Lee")]
    assert all(texts[r.doc_id][r.start : r.end] == r.text for r in rows)


def test_report(spark):
    d = docs(spark, *["mail a@b.co"] * 12, "clean")
    r = S.pii_report(d, S.pii_scan(d)).first()
    assert (r.safe, r.total_scanned, r.pii_count, len(r.pii_found), len(r.issues)) == (False, 13, 12, 10, 5)
    assert r.issues[0] == "Found EMAIL_ADDRESS (score=0.95): 'a@b.co'"
    clean = S.pii_report(d.filter("doc_id = 12"), S.pii_scan(d.filter("doc_id = 12"))).first()
    assert clean.safe and clean.pii_count == 0 and clean.pii_found == [] and clean.issues == []


def test_samples(spark):
    d = docs(spark, *map(str, range(50)))
    assert S.sample_for_scan(d).count() == 50 and S.sample_for_scan(d, sample_size=20).count() == 20
    assert S.sample_for_scan(d, sample_size=100).count() == 50


def test_licenses(spark):
    df = spark.createDataFrame([(x,) for x in ["MIT ", "cc-by-nc-4.0", "gpl-3.0", None]], "l string")
    rows = df.select(S.license_class(F.col("l")).alias("c"), S.license_compatible(F.col("l")).alias("ok")).collect()
    assert [(r.c, r.ok) for r in rows] == [("permissive", True), ("research_only", True), ("other", False), (None, True)]
    configs = spark.createDataFrame([(0, "m", "d", False), (1, "bad", "custom", False), (2, "m", "unknown", True)], "config_id int, model string, dataset string, web_fetcher boolean")
    lic = spark.createDataFrame([("m", "MIT"), ("d", "llama3"), ("bad", "GPL-3.0"), ("custom", "gpl-3.0")], "name string, license string")
    got = {r.config_id: r for r in S.check_licenses(configs, lic).collect()}
    assert got[0].passed and got[0].issues == []
    assert not got[1].passed and got[1].issues == ["Model 'bad' has license 'gpl-3.0' which may restrict fine-tuning."]
    assert got[1].dataset_license is None and not got[2].passed and got[2].issues[0].startswith("Web fetcher")


def test_gate_on_missing_results(spark):
    pii = spark.createDataFrame([(0, True), (1, False), (2, True)], "config_id int, safe boolean")
    lic = spark.createDataFrame([(0, True), (1, True), (3, True)], "config_id int, passed boolean")
    assert {r.config_id: r.safe for r in S.safety_gate(pii, lic).collect()} == {0: True, 1: False, 2: True, 3: True}
    assert {r.config_id: r.safe for r in S.safety_gate(pii, lic, on_error="fail").collect()} == {0: True, 1: False, 2: False, 3: False}


def test_offsets_of_many_findings(spark):
    text = "".join(f"é{i} mail u{i}@x.org, " for i in range(700))
    rows = S.pii_scan(docs(spark, text, None)).filter("type = 'EMAIL_ADDRESS'").collect()
    assert len(rows) == 700 and all(text[r.start : r.end] == r.text for r in rows)


def test_license_names_and_tags(spark):
    df = docs(spark, "Licensed under the BSD-3-Clause license.", "// SPDX-License-Identifier: MIT.", "SPDX-License-Identifier: GPL-3.0-only", "released under the Foo License", None)
    got = sorted((r.doc_id, r.license) for r in S.license_mentions(df).collect())
    assert got == [(0, "bsd-3-clause"), (1, "mit"), (2, "gpl-3.0-only")]
    named = df.withColumn("source", F.when(F.col("doc_id") < 3, "a").otherwise("b"))
    report = {r.source: (r.passed, r.licenses) for r in S.license_report(S.license_mentions(named, keep=("source",)), "source", named).collect()}
    assert report == {"a": (False, ["bsd-3-clause", "gpl-3.0-only", "mit"]), "b": (True, [])}


def test_persons_pass_the_filter_of_names(spark):
    names = spark.createDataFrame([(f"Given{i}", f"Family{i % 50}") for i in range(300)] + [("Ann", None), ("Zoë", "Åberg")], "given string, family string")
    rows = [(i, f"x Given{i}  Family{i % 50} Given{i} Family{(i + 1) % 50} y") for i in range(300)] + [(900, None), (901, ""), (902, "Ann"), (903, "　Zoë\tÅberg"), (904, "Zoë Åberg Zoë Åberg")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bits = S.name_filter(names.dropna())
    assert 8 * len(bits) >= S.NAME_BITS[0] and 0 < np.unpackbits(bits).sum() <= 3 * 301
    got = sorted((r["doc_id"], r["start"], r["text"]) for r in S.person_scan(df, names).collect())
    want = [(i, 2, f"Given{i}  Family{i % 50}") for i in range(300)] + [(903, 1, "Zoë\tÅberg"), (904, 0, "Zoë Åberg"), (904, 10, "Zoë Åberg")]
    assert got == sorted(want)
    plan = S.person_scan(df, names)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" not in plan
    assert S.person_scan(df, names.limit(0)).count() == 0


def test_phone_forms(spark):
    forms = ["+1 (555) 123-4567", "(555) 123-4567", "555-123-4567", "+1-555-123-4567", "555.123.4567"]
    others = ["5551234567", "55-123-4567", "1555-123-45678"]
    df = docs(spark, *[f"call {x} now" for x in forms + others])
    found = {r["doc_id"]: r["text"] for r in S.pii_scan(df).collect() if r["type"] == "PHONE_NUMBER"}
    assert found == dict(enumerate(forms))
