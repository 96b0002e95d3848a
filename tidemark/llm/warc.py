"""WARC archives: writing captures, and assembling them again.

Every capture is three records: the response (or, where an earlier page has the
same payload, a revisit that names the payload by its digest), the request and a
metadata record; request and metadata name the capture's response in
WARC-Concurrent-To. Reading parses the archives record by record, joins the
records of a capture through those identifiers, however they are linked, and gives
one nested row per capture.

Writing stays in DataFrame functions: a record ends in two line ends, which is
the line separator given to Spark's text writer, so the archives go wherever
Spark can write. Files hold whole captures and at most about ``FILE_BYTES``.
The first page of each payload comes from a partial minimum per digest, kept as a
table; pages meet it in a join that the adaptive skew join can then split if one
payload is hot.

Defined cases: null html counts as empty (a response with no payload bytes).
Null urls are read back as null; control characters and blanks in a url are
percent-encoded in headers and whole in the metadata. Null page ids never win
over others; rows that repeat the smallest page id and payload are all
responses. Records that an archive repeats under one identifier count once. Broken
records are kept as such and end no job. A capture without response, with several
requests or with several metadata records is one row. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, scratch_path, staged

END = "\r\n\r\n"
FILE_BYTES = 256 << 20
MOST_RECORDS = 100_000
DATE = "1970-01-01T00:00:00Z"
#: Digits of the two base-32 alphabets: Java's, and that of RFC 4648.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = ("record_id string, kind string, concurrent_to array<string>, uri string, payload_digest string, "
           "payload_bytes long, note string, payload binary")


def base32_sha1(c: Column) -> Column:
    """Bare upper-case base-32 SHA-1: 160 bits as eight groups of four digits."""
    h = F.sha1(c)
    groups = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _id(space: str, kind: str) -> Column:
    h = F.md5(F.concat(F.lit(f"{space}|{kind}|"), F.col("capture").cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: str | Column, record_id: Column, headers: list, block: Column) -> Column:
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind, F.lit("\r\nWARC-Record-ID: "), record_id]
    for k, v in [("WARC-Date", F.lit(DATE)), *headers]:
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{k}: "), v), F.lit("")))  # a null header is left out
    return F.concat(*lines, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          min_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the pages as gzip WARC archives below ``path``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    first = staged(d.groupBy(base32_sha1(F.col("html")).alias("digest")).agg(F.min("page_id").alias("first")), "payloads")
    d = d.withColumn("digest", base32_sha1(F.col("html"))).join(first, "digest")
    again = ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("html") >= min_revisit_bytes)
    d = d.withColumn("again", again).withColumn("capture", F.monotonically_increasing_id())
    space = uuid.uuid4().hex
    response = _id(space, "response")
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    target = ("WARC-Target-URI", uri)
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(END))
    profile = F.when(F.col("again"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    host = F.coalesce(F.regexp_extract(uri, "^[a-z]+://([^/?#]*)", 1), F.lit(""))
    where = F.coalesce(F.regexp_extract(uri, "^[a-z]+://[^/?#]*([^#]*)", 1), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(where == "", "/").otherwise(where), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    joined = ("WARC-Concurrent-To", response)
    answer = _record(F.when(F.col("again"), "revisit").otherwise("response"), response,
                     [target, digest, ("WARC-Profile", profile), ("Content-Type", F.lit("application/http; msgtype=response"))],
                     F.concat(http, F.when(F.col("again"), "").otherwise(F.col("html"))))
    request = _record("request", _id(space, "request"),
                      [target, joined, ("Content-Type", F.lit("application/http; msgtype=request"))], ask)
    note = F.to_json(F.struct("page_id", "url"))
    metadata = _record("metadata", _id(space, "metadata"), [target, joined, ("Content-Type", F.lit("application/json"))], note)
    longest = pages.agg(F.max(F.octet_length(html_col))).first()[0] or 0
    most = max(1, min(MOST_RECORDS, file_bytes // (longest + 4096)))
    d.select(F.concat_ws(END, answer, request, metadata).alias("value")).write.option("lineSep", END) \
        .option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


#: Compressed bytes that are inflated at once.
SLICE = 1 << 16


def _inflate(content: bytes) -> bytes:
    """The content of a gzip file of one or many members, or of a plain file, in time
    linear in its length; what comes before a damaged member, if one is."""
    if content[:2] != b"\x1f\x8b":
        return content
    data, at, out = memoryview(content), 0, []
    while bytes(data[at:at + 2]) == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        try:
            while at < len(data) and not z.eof:
                part = data[at:at + SLICE]
                out.append(z.decompress(part))
                at += len(part) - len(z.unused_data)
        except zlib.error:
            break
    return b"".join(out)


def _broken(reason: str) -> dict:
    return {"record_id": None, "kind": "broken", "concurrent_to": [], "uri": None, "payload_digest": None, "payload_bytes": None,
            "note": reason, "payload": None}


def parse(content: bytes, with_payload: bool = True) -> Iterator[dict]:
    """The records of one archive. A response's payload is what follows its HTTP
    header; digest and length are computed from it, a revisit's digest is its header's.
    A record whose header or block is cut off, or whose length is missing or no
    number, is of kind ``broken``, with the reason as its note; reading goes on at the
    next record that starts after it."""
    data, at = memoryview(raw := _inflate(content)), 0
    while (at := raw.find(b"WARC/", at)) >= 0:
        stop = raw.find(b"\r\n\r\n", at)
        if stop < 0:
            yield _broken("header cut off")
            return
        head, concurrent = {}, []
        for line in bytes(data[at:stop]).decode("utf-8", "replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            head[k.strip().lower()] = v.strip()
            if k.strip().lower() == "warc-concurrent-to":
                concurrent.append(v.strip())
        begin, length = stop + 4, head.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            yield _broken(f"length {length!r}")
            at = begin
            continue
        at = begin + int(length)
        if at > len(raw):
            yield _broken("block cut off")
            return
        kind = head.get("warc-type", "")
        out = {"record_id": head.get("warc-record-id"), "kind": kind, "concurrent_to": concurrent,
               "uri": head.get("warc-target-uri"), "payload_digest": None, "payload_bytes": None, "note": None, "payload": None}
        if kind == "response":
            body = raw.find(b"\r\n\r\n", begin, at)
            payload = data[body + 4 if body >= 0 else at:at]
            out["payload_bytes"] = len(payload)
            out["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out["payload"] = bytes(payload) if with_payload else None
        elif kind == "revisit":
            out["payload_digest"] = (head.get("warc-payload-digest") or "").rpartition(":")[2].upper() or None
        elif kind in ("request", "metadata"):
            out["note"] = bytes(data[begin:at]).decode("utf-8", "replace")
        yield out


def records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("uri", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("note", pa.string()), ("payload", pa.binary())])
        for b in batches:
            for file in b.column("content"):
                rows, size = [], 0
                for r in parse(file.as_py(), with_payload):
                    rows.append(r)
                    size += 500 + len(r["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(run, RECORDS)


def _capture_of(some: DataFrame) -> DataFrame:
    """The records with ``capture_id``: the smallest identifier that all records of a
    capture lead to. Where each record names one other that names none, as archives
    of this module do, that is the one named; other records are joined through all
    their identifiers, whatever the number of steps."""
    named = F.element_at("concurrent_to", 1)
    keyed = some.withColumn("capture_id", F.when(F.size("concurrent_to") > 0, named).otherwise(F.col("record_id")))
    linked = some.where(F.size("concurrent_to") > 0).select("record_id", F.explode("concurrent_to").alias("other"))
    # named records that name others themselves, or records that name several
    further = linked.select(F.col("other").alias("record_id")).join(linked.select("record_id"), "record_id", "left_semi") \
        .unionByName(some.where(F.size("concurrent_to") > 1).select("record_id"))
    if further.isEmpty():
        return keyed
    root = connected_components(linked.where("record_id IS NOT NULL"), "record_id", "other")
    return keyed.join(root, F.col("record_id") == F.col("node"), "left") \
        .withColumn("capture_id", F.coalesce("root", "capture_id")).drop("node", "root")


def captures(some: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (the first of them, or the
    revisit, by its identifier; null if the archives lack it), request and metadata
    (the first of each), requests and notes (all of them, as arrays). Records without
    identifier or link are captures of their own; warcinfo, conversion and broken
    records belong to none."""
    some = some.where(F.col("kind").isin("response", "revisit", "request", "metadata"))
    once = some.where("record_id IS NOT NULL").dropDuplicates(["record_id"])
    alone = some.where("record_id IS NULL")
    keyed = _capture_of(once.unionByName(alone))
    # a record without any identifier keeps to itself
    key = F.coalesce(F.col("capture_id"), F.concat(F.lit("record "), F.monotonically_increasing_id().cast("string")))

    def of(*cols: str) -> Column:
        return F.struct("record_id", "kind", "uri", *cols)

    def all_of(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, of("note"))))

    answer = F.when(F.col("kind").isin("response", "revisit"), of("payload_digest", "payload_bytes", "payload"))
    got = keyed.withColumn("capture_id", key).groupBy("capture_id").agg(
        F.min_by(answer, F.when(answer.isNotNull(), F.coalesce("record_id", F.lit("")))).alias("response"),
        all_of("request").alias("requests"), all_of("metadata").alias("notes"))
    return got.select("capture_id", "response", F.get("requests", F.lit(0)).alias("request"), F.get("notes", F.lit(0)).alias("metadata"),
                      "requests", "notes")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_revisit_bytes: int = 0, with_payload: bool = False) -> DataFrame:
    """Write the pages as archives in the shared folder, read these back and say of
    each capture what it holds and whose payload it revisits."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, id_col, url_col, html_col, min_revisit_bytes)
    read = staged(records(spark, path, with_payload).drop(*([] if with_payload else ["payload"])), "warc_records")
    if not with_payload:
        read = read.withColumn("payload", F.lit(None).cast("binary"))
    note = F.from_json("metadata.note", f"page_id {pages.schema[id_col].dataType.simpleString()}, url string")
    c = captures(read).withColumn("page", note).select(F.col("page.page_id").alias(id_col), F.col("page.url").alias(url_col),
                                                       "response", "request", "metadata", "requests", "notes")
    held = c.where("response.kind = 'response'").groupBy(F.col("response.payload_digest").alias("payload_digest")) \
        .agg(F.min(id_col).alias("__first"), F.max("response.payload_bytes").alias("payload_bytes"))
    held = staged(held, "payloads")
    c = c.withColumn("payload_digest", F.col("response.payload_digest")).join(held, "payload_digest", "left")
    return c.select(id_col, url_col, "payload_bytes", "payload_digest", F.col("response.kind").alias("record_type"),
                    F.when(F.col("response.kind") == "revisit", F.col("__first")).alias("refers_to"), "response", "request", "metadata", "requests", "notes")
