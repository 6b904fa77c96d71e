"""WARC archives: written by Spark, read back, and assembled into one row per capture.

A capture is three records that name each other: a ``request`` and a ``metadata`` record are concurrent to its ``response``
(or ``revisit``). ``write_archive`` writes them as gzipped WARC/1.1 files through Spark's text sink, whose line end is the blank
lines that close a record, so files come from Spark's commit protocol and any store it writes to will do. ``read_records``
parses archives by Content-Length, and ``transactions`` joins the three kinds through WARC-Concurrent-To.

Defined results: a null payload is empty; a null url or id leaves its header out and comes back as null; of rows with equal
payloads of at least ``min_bytes`` bytes the smallest id (and every row that repeats it) is the response; a group without any id
is all responses; line ends in a url become blanks; rows that are equal throughout give as many equal captures; an empty
table gives none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kit import batches_of, fresh_path, materialize, read

MIN_REVISIT_BYTES = 100
EOL = "\r\n"
#: Ends a record: the two line ends after its block.
RECORD_END = EOL + EOL
RECORDS = (
    "record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, http_status int, fields map<string,string>, payload binary"
)


def _urn(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p, F.lit("~")) for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: Column | str, record_id: Column, date: str, uri: Column, more: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """A whole record but for its end; headers whose value is null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri), *more]
    fields += [("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit("WARC/1.1" + EOL), *[F.coalesce(F.concat(F.lit(n + ": "), v, F.lit(EOL)), F.lit("")) for n, v in fields], F.lit(EOL), block)


def plan_captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Digest, record type and first holder of every payload.

    Only payloads found more than once take part in the join; that table is stored, so its size is known to the planner.
    Partial counts make a payload that a third of all pages share one row per task.
    """
    own = pages.select(
        F.col(id_col).alias("_id"),
        F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]+", " ").alias("_url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("_payload"),
    ).withColumns({"_digest": F.sha2("_payload", 256), "_bytes": F.octet_length("_payload").cast("long")})
    holder = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_url"))).alias("_first")
    shared = own.filter(F.col("_bytes") >= min_bytes).groupBy("_digest").agg(holder, F.count(F.lit(1)).alias("_n"))
    shared = materialize(shared.filter("_n > 1 and _first is not null").drop("_n"), "warc-shared")
    out = own.join(shared, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first._id"))
    return out.withColumns({"_type": F.when(revisit, "revisit").otherwise("response"), "_refers": F.when(revisit, F.col("_first"))}).drop("_first")


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    records_per_file: int = 999,
) -> None:
    """Writes request, response or revisit, and metadata records of every page into gzipped files under ``path``.

    A revisit names the record that holds its payload in WARC-Refers-To. ``records_per_file`` bounds what a reader holds at once, for pages of usual sizes; a file is one gzip member.
    """
    p = plan_captures(pages, id_col, url_col, payload_col, min_bytes)
    key, first = F.col("_id").cast("string"), F.col("_refers._id").cast("string")
    # the row's place tells equal rows apart only through their url; equal captures share their ids
    capture = _urn("capture", key, F.col("_digest"), F.col("_url"))
    holder = F.when(first.isNotNull(), _urn("capture", first, F.col("_digest"), F.col("_refers._url")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("_bytes").cast("string"), F.lit(RECORD_END))
    is_revisit = F.col("_type") == "revisit"
    digest = F.concat(F.lit("sha256:"), F.col("_digest"))
    profile = F.when(is_revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    main = _record(
        F.col("_type"),
        capture,
        date,
        F.col("_url"),
        [("WARC-Payload-Digest", digest), ("WARC-Refers-To", holder), ("WARC-Refers-To-Target-URI", F.col("_refers._url")), ("WARC-Profile", profile)],
        "application/http; msgtype=response",
        F.when(is_revisit, http).otherwise(F.concat(http, F.col("_payload"))),
    )
    ask = F.concat(F.lit("GET "), F.coalesce(F.col("_url"), F.lit("/")), F.lit(f" HTTP/1.1{RECORD_END}"))
    request = _record("request", _urn("request", key, F.col("_digest"), F.col("_url")), date, F.col("_url"), [("WARC-Concurrent-To", capture)], "application/http; msgtype=request", ask)
    facts = [("page-id", key)]
    body = F.concat(*[F.coalesce(F.concat(F.lit(n + ": "), v, F.lit(EOL)), F.lit("")) for n, v in facts])
    metadata = _record("metadata", _urn("metadata", key, F.col("_digest"), F.col("_url")), date, F.col("_url"), [("WARC-Concurrent-To", capture)], "application/warc-fields", body)
    records = p.select(F.explode(F.array(request, main, metadata)).alias("record"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split(EOL)[1:]:
        name, sep, value = line.partition(": ")
        if sep:
            out[name.lower()] = value
    return out


def _whole(text: str | bytes) -> int | None:
    """A whole number, None if it is written otherwise."""
    text = text.decode("ascii", "replace") if isinstance(text, bytes) else text
    text = text.strip()
    return int(text) if text.isascii() and text.isdigit() and len(text) < 19 else None


def _status(http: bytes) -> int | None:
    parts = http.split(None, 2)
    return _whole(parts[1][:9]) if http.startswith(b"HTTP/") and len(parts) > 1 else None


def parse_archive(data: bytes, with_payload: bool = True) -> Iterator[tuple]:
    """The records of one archive, gzipped (in one or many members) or not; a damaged end closes the archive.

    A record whose length is no number is passed over, and a status that is none comes back as null.
    """
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data[:2] == b"\x1f\x8b":
            one = zlib.decompressobj(31)
            try:
                parts.append(one.decompress(data))
            except zlib.error:  # a damaged member ends what can be read
                break
            data = one.unused_data
        data = parts[0] if len(parts) == 1 else b"".join(parts)
        parts.clear()
    at, end = 0, RECORD_END.encode()
    while (at := data.find(b"WARC/", at)) >= 0:
        head_end = data.find(end, at)
        if head_end < 0:
            return
        head = _headers(data[at:head_end])
        start = head_end + 4
        size = _whole(head.get("content-length", "0"))
        if size is None:
            at = start
            continue
        stop = start + size
        if stop > len(data):
            return
        block, at = data[start:stop], stop
        kind, fields, payload, status = head.get("warc-type"), None, None, None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(end)
            status = _status(http)
            payload = body if kind == "response" else None
        elif kind == "metadata":
            fields = [tuple(x.split(": ", 1)) for x in block.decode("utf-8", "replace").split(EOL) if ": " in x]
        digest = (head.get("warc-payload-digest") or "").rpartition(":")[2] or None
        if payload is not None:
            digest = hashlib.sha256(payload).hexdigest()
        size = None if payload is None else len(payload)
        yield (
            head.get("warc-record-id"),
            kind,
            head.get("warc-concurrent-to"),
            head.get("warc-refers-to"),
            head.get("warc-target-uri"),
            digest,
            size,
            status,
            fields,
            payload if with_payload else None,
        )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``; digest and size are taken from the payload where there is one.

    Without payloads the rows are slim. One file is held at a time.
    """
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("warc_type", pa.string()),
            ("concurrent_to", pa.string()),
            ("refers_to", pa.string()),
            ("target_uri", pa.string()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("http_status", pa.int32()),
            ("fields", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from batches_of(parse_archive(content.as_py(), with_payload), schema, 500 if with_payload else 4000)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORDS)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request`` and ``metadata``.

    A request or metadata record that is there twice counts once; one without its response makes no capture, and a
    response without the others has nulls.
    """
    main = records.filter(F.col("warc_type").isin("response", "revisit"))
    main = main.select(
        F.col("record_id").alias("capture_id"),
        F.struct("warc_type", "refers_to", "target_uri", "payload_digest", "payload_bytes", "http_status", "payload").alias("response"),
    )

    def side(kind: str, name: str, *columns: str) -> DataFrame:
        own = records.filter((F.col("warc_type") == kind) & F.col("concurrent_to").isNotNull())
        return own.dropDuplicates(["concurrent_to"]).select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", *columns).alias(name))

    return main.join(side("request", "request", "target_uri"), "capture_id", "left").join(side("metadata", "metadata", "fields"), "capture_id", "left")


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with ``held``: the capture that a revisit refers to (``page_id`` from its metadata, ``payload_bytes``), null for responses and where it isn't there.

    Captures that hold something are one row each, and those that refer to one of them, however many, are the other side of the join.
    """
    number = F.element_at("metadata.fields", F.lit("page-id"))
    holders = captures.filter(F.col("response.warc_type") == "response").groupBy(F.col("capture_id").alias("_held_id"))
    holders = holders.agg(F.first(F.struct(number.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"))).alias("held"))
    asked = captures.filter(F.col("response.refers_to").isNotNull()).select(F.col("response.refers_to").alias("_held_id")).distinct()
    holders = materialize(holders.join(asked, "_held_id", "left_semi"), "warc-holders")
    return captures.join(holders, F.col("response.refers_to") == F.col("_held_id"), "left").drop("_held_id")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archive(read(spark, folder, "pages", "page_id", "url", "html"), path)
    records = materialize(read_records(spark, path, with_payload=False), "warc-records")
    out = resolved(materialize(transactions(records), "warc-captures"))
    return out.select(
        F.element_at("metadata.fields", F.lit("page-id")).cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", "held.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        F.col("held.page_id").cast("long").alias("refers_to"),
    )


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""
QUERIES = {"op3_warc": op3_warc}
ORACLES = {"op3_warc": SQL}
