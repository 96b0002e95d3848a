import base64
import hashlib
from functools import cache

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe as B
from tidemark.llm.queries import QUERIES

from .conftest import docs_of, with_clash


@cache
def the_library():
    import public_tokenizers as P
    with open(P.path(B.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return the_library()


TEXT = st.text(alphabet=st.sampled_from(list("ab'srelvd1 .,!\n\t\r\x0b\x1c  　é中😀ßŁ9٣<|>")), max_size=120)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_the_librarys(text):
    got = B.codec().encode(text)
    assert np.frombuffer(got, "<u4").tolist() == the_library().encode_ordinary(text)
    assert B.codec().decode(got) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=200))
def test_heap_and_list_merge_alike(piece):
    bpe = B.codec()
    short = piece[:B.LONG]
    assert bpe._merge_long(short) == bpe.merge(short) or short in bpe.ranks
    assert b"".join(bpe.bytes_of[i] for i in bpe.merge(piece)) == piece


def test_long_runs_take_little_time(library):
    run = "abcdefghij" * 30_000
    assert np.frombuffer(B.codec().encode(run), "<u4").tolist() == library.encode_ordinary(run)


def shared_spans(text, chunk, overlap, parts):
    """Boundaries by chunks that meet, as the operator joins them; None where two don't."""
    out, lo, starts = [], 0, list(range(0, max(1, len(text) - overlap), chunk))
    for s in starts:
        piece = text[s:] if s == starts[-1] else text[s:s + chunk + overlap]
        at = [int(x) + s for x in B.boundaries(parts(piece))]
        if s == starts[-1]:
            return out + [x for x in at if x >= lo]
        sure = [x for x in at if x <= s + len(piece) - B.LOOKAHEAD and x >= s + chunk]
        after = text[s + chunk:] if s + chunk == starts[-1] else text[s + chunk:s + 2 * chunk + overlap]
        heads = {int(x) + s + chunk for x in B.boundaries(parts(after)) if x <= min(overlap, len(after) - B.LOOKAHEAD)}
        meet = [x for x in sure if x in heads]
        if not meet:
            return None
        out += [x for x in at if lo <= x < meet[0]]
        lo = meet[0]


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(12, 30))
def test_boundaries_meet_where_the_whole_text_has_them(text, chunk):
    parts = B.codec().parts
    got = shared_spans(text * 3, chunk, 11, parts)
    assert got is None or got == B.boundaries(parts(text * 3)).tolist()


def test_chunked_texts_encode_like_whole_ones(spark, library):
    rows = [(1, None), (1, None), (2, ""), (3, "it's we're they'll   many\n\n\n words 12 345 " * 40), (None, "x"),
            (4, "z" * 900), (5, "a b " * 90 + "q" * 700 + " c d" * 90), (6, " " * 500 + "end"), (7, "中文 текст 😀 " * 60), (7, "don't"),
            (8, "<|endoftext|> " * 50)]
    got = B.decode(B.encode(docs_of(spark, rows), chunk=100, overlap=20)).collect()
    want = sorted((str(i), tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.bytes)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_empty_table_and_bad_ids(spark):
    assert B.encode(docs_of(spark, [])).collect() == []
    ids = lambda *x: np.array(x, "<u4").tobytes()
    df = with_clash(spark.createDataFrame([(1, ids(64, 65)), (2, None), (3, ids(10 ** 6)), (4, b"abc"), (5, b"")], "doc_id long, ids binary"))
    got = {r.doc_id: r.bytes for r in B.decode(df).collect()}
    assert got[1] == b"ab" and got[5] == b"" and got[2] is got[3] is got[4] is None
    with pytest.raises(ValueError):
        B.encode(df, text_col="ids", chunk=10, overlap=20)


def test_query_against_the_library(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
