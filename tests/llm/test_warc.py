import base64
import gzip
import hashlib

from tidemark.llm import warc as W
from tidemark.session import scratch_path

from .conftest import with_clash

ROWS = [(5, "http://a.example/x?q=1#f", "<p>é\r\n\r\nWARC/1.1\r\n"), (3, "http://b.example", "<p>é\r\n\r\nWARC/1.1\r\n"), (9, "http://a.example/x", None),
        (2, None, ""), (7, "http://bad host/\r\nWARC-Type: x", "own"), (8, "u", "y" * 300_000), (8, "u", "y" * 300_000), (None, "n", "own"),
        (None, "only", "lonely"), (4, "z", "short\r\n\r\n")]


def pages(spark, rows):
    return with_clash(spark.createDataFrame(rows, "page_id long, url string, html string"))


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, u, h in rows:
        raw, f = (h or "").encode(), first.get(h or "")
        out.append((i, u, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == f else "revisit", None if i == f else f))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip(spark):
    assert got(W.round_trip(pages(spark, ROWS))) == plain(ROWS)


def test_payloads_and_nested_records(spark):
    c = {r.page_id: r for r in W.round_trip(pages(spark, ROWS), with_payload=True).where("page_id is not null").collect()}
    assert bytes(c[3].response.payload).decode() == ROWS[0][2] and c[5].response.payload is None
    assert c[5].request.note.startswith("GET /x?q=1 HTTP/1.1\r\nHost: a.example\r\n") and c[5].request.uri == "http://a.example/x?q=1#f"
    assert c[7].url == "http://bad host/\r\nWARC-Type: x" and c[7].metadata.note


def test_small_payloads_are_not_revisited(spark):
    kinds = {r.page_id: r.record_type for r in W.round_trip(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]),
                                                            min_revisit_bytes=4).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_files_are_warc(spark):
    path = scratch_path(spark, "w")
    W.write(pages(spark, ROWS), path, file_bytes=1)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) == len(ROWS)  # one capture each
    for f in files:
        raw = gzip.decompress(bytes(f.content))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        recs = list(W.parse(bytes(f.content)))
        assert [r["kind"] for r in recs][1:] == ["request", "metadata"] and recs[1]["concurrent_to"] == [recs[0]["record_id"]]


def test_foreign_archives(spark):
    """Members of their own, other order, the response naming its request, and a record twice."""
    def rec(kind, own, other, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{own}>\r\n" + (f"WARC-Concurrent-To: <{other}>\r\n" if other else "")
        return head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    parts = [rec("warcinfo", "i", None, b"software: x"), rec("request", "q", None, b"GET / HTTP/1.1\r\n\r\n"), rec("metadata", "m", "q", b"k: v"),
             rec("response", "r", "q", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\xff")]
    content = b"".join(gzip.compress(p) for p in [*parts, parts[1]])
    rows = [tuple(r.values()) for r in W.parse(content)]
    c = W.captures(spark.createDataFrame(rows, W.RECORDS)).collect()
    assert len(c) == 1 and c[0].request.record_id == "<q>" and c[0].metadata.note == "k: v" and bytes(c[0].response.payload) == b"body\xff"


def test_empty_table(spark):
    assert W.round_trip(pages(spark, [])).count() == 0


def rec(kind, own, others, block, length=None):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n" + (f"WARC-Record-ID: <{own}>\r\n" if own else "")
    head += "".join(f"WARC-Concurrent-To: <{o}>\r\n" for o in others)
    size = b"" if length == "none" else b"Content-Length: %s\r\n" % (str(len(block)).encode() if length is None else length.encode())
    return head.encode() + size + b"\r\n" + block + b"\r\n\r\n"


def test_captures_however_linked(spark):
    body = b"HTTP/1.1 200 OK\r\n\r\nx"
    parts = [rec("response", "r1", [], body), rec("request", "q1", ["r1"], b"GET 1"), rec("metadata", "m1", ["q1"], b"by request"),
             rec("metadata", "m2", ["r1", "q1"], b"both"), rec("request", "q2", ["gone"], b"GET 2"), rec("metadata", "m3", ["gone"], b"no response"),
             rec("request", None, [], b"GET 3"), rec("request", None, [], b"GET 4"), rec("revisit", "v", ["q5"], b""), rec("request", "q5", [], b"GET 5"),
             rec("warcinfo", "i", [], b"x")]
    rows = [tuple(r.values()) for r in W.parse(b"".join(gzip.compress(p) for p in parts))]
    c = W.captures(spark.createDataFrame(rows, W.RECORDS)).collect()
    got = sorted((r.response.record_id if r.response else None, tuple(x.note for x in r.requests), tuple(x.note for x in r.notes)) for r in c if r.response)
    assert got == [("<r1>", ("GET 1",), ("by request", "both")), ("<v>", ("GET 5",), ())]
    assert sorted(tuple(x.note for x in r.requests + r.notes) for r in c if not r.response) == [("GET 2", "no response"), ("GET 3",), ("GET 4",)]


def test_broken_records_end_nothing(spark):
    good = rec("request", "q", [], b"GET /")
    content = rec("request", "a", [], b"x", "none") + rec("request", "b", [], b"x", "-3") + rec("request", "c", [], b"x", "9z") + good + rec("request", "d", [], b"x", "999")
    kinds = [(r["kind"], r["record_id"]) for r in W.parse(content)]
    assert kinds == [("broken", None)] * 3 + [("request", "<q>"), ("broken", None)]
    assert [r["kind"] for r in W.parse(good + b"WARC/1.0\r\nWARC-Type: requ")] == ["request", "broken"]
    assert [r["kind"] for r in W.parse(gzip.compress(good) + b"\x1f\x8bdamaged")] == ["request"]
    assert list(W.parse(b"")) == [] and [r["kind"] for r in W.parse(gzip.compress(good)[:-4])] == ["request"]


def test_a_member_per_record_takes_linear_time():
    import time
    one = gzip.compress(rec("request", "q", [], b"GET /" * 50))
    t = []
    for n in (2_000, 40_000):
        start = time.perf_counter()
        assert len(W._inflate(one * n)) == n * len(gzip.decompress(one))
        t.append(time.perf_counter() - start)
    assert t[1] < 100 * t[0] + 0.5
