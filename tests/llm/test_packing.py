import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing as P

from .conftest import docs_of


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.vocabulary_path())
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'1 ., \n\té 　\x1cZ")), max_size=40))
def test_remembered_words_give_the_tokenizers_ids(text):
    w = P._tokenizer(P.vocabulary_path())
    assert w.encode(text) == w.inner.encode(text, add_special_tokens=False).ids


def test_special_names_give_the_default_ids():
    from tokenizers import Tokenizer
    plain, w = Tokenizer.from_file(P.vocabulary_path()), P.WordTokenizer(P.vocabulary_path())
    assert w.special
    for name in w.special:
        for text in (f"a {name} b", name, f"a{name}.b c", f"one {name}{name} two, three", f" {name} x"):
            assert w.encode(text) == plain.encode(text, add_special_tokens=False).ids
    assert w.encode("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_memory_bound():
    w = P.WordTokenizer(P.vocabulary_path(), memory=50)
    text = " ".join(f"w{i}" for i in range(400))
    want = w.inner.encode(text, add_special_tokens=False).ids
    assert w.encode(text) == want and w.encode(text + " " + text) == w.inner.encode(text + " " + text, add_special_tokens=False).ids


def least_bins(lengths, room):
    """The fewest bins, by trying all partitions."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= room:
                go(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_and_best_fit_enclose_the_optimum(lengths):
    x = np.array(lengths)
    bound = P.lower_bound(np.bincount(x, minlength=13), 12)
    bins, offsets, room = P.best_fit(x, 12)
    least = least_bins(sorted(lengths, reverse=True), 12)
    assert bound <= least <= len(room)
    check_layout(list(zip(bins.tolist(), offsets.tolist(), lengths)), 12)


def test_bound_sees_more_than_the_sum():
    h = np.zeros(1025, int)
    h[600], h[400] = 10, 3
    assert P.lower_bound(h) == 10
    h = np.zeros(1025, int)
    h[400] = 10  # two fit a bin
    assert P.lower_bound(h) == 5 == len(P.best_fit(np.repeat(400, 10))[2])


def check_layout(rows, capacity):
    by = defaultdict(list)
    for b, o, n in rows:
        by[b].append((o, n))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_pieces():
    assert P.cut(5, 8) == [(0, 5)] and P.cut(8, 8) == [(0, 8)] and P.cut(9, 8) == [(0, 1), (1, 8)] and P.cut(16, 8) == [(0, 8), (8, 8)]


def test_documents_round_trip(spark, tok):
    rows = [(1, None), (1, None), (2, ""), (3, "hello there  world\n"), (None, "x"), (4, "many words here " * 2000), (5, "<|endoftext|>"), (5, "ok")]
    got = P.pack_documents(docs_of(spark, rows)).collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in got:
        part = np.frombuffer(r.ids, "<u4")
        whole = [tok.encode(t, add_special_tokens=False).ids + [2] for t in texts[r.doc_id]]
        assert any(w[r.start:r.start + r.length] == part.tolist() for w in whole) and zlib.crc32(r.ids) == r.ids_crc32
    n = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in got) == n
    assert check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024) == -(-n // 1024)
    assert P.pack_documents(docs_of(spark, [])).count() == 0


def test_partitions_exchange_until_the_bound_holds(spark):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1025, 6000)
    d = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "uid long, length long").repartition(40)
    from tidemark.llm.common import staged
    placed, told = P.pack(staged(d, "t"), exchange=1500)
    rows = [(r.bin, r.offset, int(lengths[r.uid])) for r in placed.collect()]
    assert len(rows) == 6000 and check_layout(rows, 1024) == told["bins"]
    alone = sum(len(P.best_fit(lengths[k::40])[2]) for k in range(40))
    assert told["lower_bound"] <= told["bins"] < alone and told["bins"] <= 1.01 * told["lower_bound"]


def test_an_exchange_never_costs_bins(spark):
    d = spark.createDataFrame([(i, 600) for i in range(300)], "uid long, length long").repartition(5)
    from tidemark.llm.common import staged
    placed, told = P.pack(staged(d, "t"), exchange=10)
    assert told["bins"] == told["lower_bound"] == 300 and placed.select("bin").distinct().count() == 300


def test_quick_word_ids_are_the_tokenizers(tok, sf):
    """Every word of the documents, and odd ones, by the ranks and by the tokenizer."""
    import pyarrow.parquet as pq
    w = P.WordTokenizer(P.vocabulary_path())
    assert w.quick is not None and P._same_vocabulary(tok, "/nowhere/other.json") is None
    words = {x for t in pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist() for x in (t or "").split(" ")}
    words |= {"'s", "it's", "''ll", "é", "中文字", "😀😀", "a\tb", "1a2b", "x" * 300, "don't.", "\x00", "​", "ﬁ", "<|end", "-–—"}
    assert all(w._word(x) == np.array(tok.encode(" " + x, add_special_tokens=False).ids, np.uint32).tobytes() for x in words)


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=12).filter(lambda x: not any(map(str.isspace, x))))
def test_quick_ids_of_any_word(word):
    w = P._tokenizer(P.vocabulary_path())
    if not any(t in word for t in w.special):
        assert w._word(word) == np.array(w.inner.encode(" " + word, add_special_tokens=False).ids, np.uint32).tobytes()


def test_certificate_is_in_the_result(spark):
    got = P.pack_documents(docs_of(spark, [(i, "word " * (1 + 37 * i % 900)) for i in range(60)])).collect()
    assert {r.lower_bound for r in got} == {got[0].lower_bound} and got[0].sequences == len({r.sequence_id for r in got}) >= got[0].lower_bound
    by = defaultdict(set)
    for r in got:
        by[r.sequence_id].add(r.certified)
    assert all(len(c) == 1 for c in by.values())
    one = P.pack_documents(docs_of(spark, [(1, "a b c")])).collect()
    assert [(r.certified, r.sequences, r.lower_bound) for r in one] == [(True, 1, 1)]


def test_a_batch_is_tokenised_in_slices():
    import pyarrow as pa

    from tidemark.llm.common import slices
    got = list(slices([pa.RecordBatch.from_arrays([pa.array(range(n))], names=["x"]) for n in (1200, 0, 3)]))
    assert [b.num_rows for b in got] == [500, 500, 200, 3]
    assert [x for b in got for x in b.column("x").to_pylist()] == [*range(1200), *range(3)]
