import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import importance as I
from tidemark.llm.queries import QUERIES

from .conftest import docs_of, with_clash

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain(docs, target, max_n, buckets=I.BUCKETS, min_words=I.MIN_WORDS, percent=I.PERCENT):
    def feats(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(feats(text))
    for text in target:
        t.update(feats(text))
    S, TT = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (TT + buckets))))
    rows = []
    for i, text in docs:
        f = feats(text)
        w = sum(map(gain, f))
        rows.append((i, len(f), w, w + I.gumbel(i), len(plain_words(text)) >= min_words))
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(may[:percent * len(may) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAzZ09 .`{~\x7fÉé中😀\n")), max_size=60))
def test_words(text):
    assert [w.decode() for w in I.words_of(text)] == plain_words(text)


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_head_never_changes_a_bucket(max_n):
    words = I.words_of("the cat and the dog and the cat é x " * 5)
    want = [zlib.crc32(b" ".join(words[i:i + n])) % 97 for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    for frequent in ([], [b"the", b"cat"], [b"the", b"the cat", b"and the", b"\xc3\xa9"]):
        assert sorted(I.Features(frequent, 97, max_n).of(words).tolist()) == sorted(want)


@pytest.mark.parametrize("max_n,head", [(1, 5), (2, 3), (3, 50_000)])
def test_whole_result(spark, max_n, head):
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 15 + i % 20))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "..."), (503, "Ää ÄÄ a_b A-B " * 2000), (7, rows[7][1]), (None, "one two " * 12)]
    target = ["w1 w2 w3 w4 Ää", None, "w1 w2"]
    t = with_clash(spark.createDataFrame([(x,) for x in target], "text string"))
    got = I.resample(docs_of(spark, rows), t, max_n=max_n, head_size=head, percent=33)
    assert as_set(got.collect()) == as_set(plain(rows, target, max_n, percent=33))


def test_empty_tables(spark):
    none, one = docs_of(spark, []), docs_of(spark, [(1, "a b")])
    assert I.resample(none, one).collect() == [] and I.resample(none, none).collect() == []
    assert as_set(I.resample(one, none).collect()) == as_set(plain([(1, "a b")], [], 1))


def test_trimmed_counts_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(I, "COUNTED", 10)
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(30)) + " the the") for i in range(20)]
    got = I.resample(docs_of(spark, rows), docs_of(spark, [(1, "the")]), percent=50)
    assert as_set(got.collect()) == as_set(plain(rows, ["the"], 1, percent=50))


def test_many_buckets(spark):
    rows = [(1, "a b c"), (2, "d")]
    got = I.resample(docs_of(spark, rows), docs_of(spark, [(1, "a")]), buckets=100_003, min_words=1, percent=50)
    assert as_set(got.collect()) == as_set(plain(rows, ["a"], 1, buckets=100_003, min_words=1, percent=50))


def test_query_columns(spark, sf):
    df = QUERIES["op12_importance_resampling"](spark, sf)
    assert dict(df.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    assert np.all(np.array(sorted(r.rank for r in df.collect() if r.rank)) == np.arange(1, df.where("rank is not null").count() + 1))
