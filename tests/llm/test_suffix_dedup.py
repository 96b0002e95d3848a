import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as S

from .conftest import docs_of


def plain(rows, length=200):
    """Every string of every text, counted."""
    count = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, d in data:
        for p in range(len(d) - length + 1):
            k = hash(d[p:p + length])
            count[k] = count.get(k, 0) + 1
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if count[hash(d[p:p + length])] > 1:
                gone[p:p + length] = True
        edges = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def cases():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, b = text(120), text(90)
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, text(300)), (5, text(40) + shared + text(40)), (6, shared),
            (7, text(30) + shared[100:500] + text(5)), (8, b + text(10) + b), (9, "a" * 700), (10, "ab" * 300), (11, "x" + "ab" * 150),
            (12, b[:199] + "!"), (13, b[:200] + "?"), (None, shared[:250]), (14, text(200)), (15, shared.replace("a", "b", 9))]
    rows += [(20 + i, f"{text(3)} {shared[:230]} {text(3)}") for i in range(12)]  # one trigger, many phrases
    rows += [(40, rows[4][1])] * 2
    return rows


@pytest.mark.parametrize("shard", [S.SHARD, 1])
def test_cases_match_brute_force(spark, shard):
    rows = cases()
    want = plain(rows)
    assert any(0 < r[2] < r[1] for r in want)
    assert got(S.remove_repeats(docs_of(spark, rows), shard=shard)) == want


def test_blocks_match_brute_force(spark, monkeypatch):
    import tidemark.llm.suffix_dedup as M
    monkeypatch.setattr(M, "BLOCK", 256)
    rows = cases()
    parts = [row for d in [(t or "").encode() for _, t in rows if len((t or "").encode()) >= 200] for row in parse(d)]
    assert all(1 <= n <= S.WINDOW for _, n in parts)
    monkeypatch.undo()
    whole = sum(len(t.encode()) - 199 for _, t in rows if t and len(t.encode()) >= 200)
    assert sum(n for _, n in parts) == whole


def parse(data):
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([data], pa.binary())], names=["t1", "t2", "data"])
    return [(s, n) for out in S._parse(iter([b])) for s, n in zip(out.column("start").to_pylist(), out.column("n").to_pylist())]


def test_kept_bytes_and_spans(spark):
    rows = cases()
    texts = {i: (t or "").encode() for i, t in rows}
    for r in S.remove_repeats(docs_of(spark, rows)).collect():
        if r.doc_id not in (3, 40, 4):
            left, at = b"", 0
            for x in r.spans:
                left += texts[r.doc_id][at:x.s]
                at = x.e
            assert left + texts[r.doc_id][at:] == bytes(r.kept) and hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_equal_strings_have_equal_phrase_places():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 101, 400, dtype=np.uint8).tobytes()
    seen = []
    for k in (0, 37):
        data = rng.integers(97, 101, 150 + k, dtype=np.uint8).tobytes() + shared + rng.integers(97, 101, 90, dtype=np.uint8).tobytes()
        s, e, a = S.phrases(data)
        trigger = np.repeat(a, e - s) - (150 + k)
        seen.append(trigger[150 + k:150 + k + 201])
    assert (seen[0] == seen[1]).all()


def test_documents_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(S.remove_repeats(docs_of(spark, rows), with_kept=False)) == plain(rows)


def test_empty_table(spark):
    assert S.remove_repeats(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("letters,n", [(2, 900), (26, 500), (1, 450), (3, 1), (2, 7)])
def test_suffix_array_is_the_byte_order(letters, n):
    data = np.random.default_rng(letters).integers(97, 97 + letters, n, dtype=np.uint8)
    data = np.concatenate((data, data[: n // 2]))
    order, rank = S.suffix_array(data)
    padded = data.tobytes() + bytes(S.LENGTH)
    strings = [padded[p:p + S.LENGTH] for p in order]
    assert strings == sorted(strings) and sorted(order.tolist()) == list(range(len(data)))
    assert [a == b for a, b in zip(strings, strings[1:])] == (rank[order][1:] == rank[order][:-1]).tolist()


def test_small_batches_and_frequent_keys_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2)
    monkeypatch.setattr(S, "BATCH", 1)
    rows = cases()
    assert got(S.remove_repeats(docs_of(spark, rows))) == plain(rows)


def test_copies_are_parsed_once(spark):
    rows = cases()
    once = sorted({r[1] or "" for r in rows})
    long = [t for t in once if len(t.encode()) >= S.LENGTH]
    parsed = []
    real = S.staged

    def seen(df, name):
        out = real(df, name)
        if name == "phrases":
            parsed.append(out.agg({"n": "sum"}).first()[0])
        return out

    S.staged = seen
    try:
        S.repeats(docs_of(spark, rows * 5))
    finally:
        S.staged = real
    assert parsed == [sum(len(t.encode()) - S.LENGTH + 1 for t in long)]
