import random

import pytest

from tidemark.llm import exact_dedup as X

from .conftest import docs_of

ROWS = [(1, "Same"), (5, "sAME"), (5, "same"), (2, None), (3, ""), (7, "ÄB"), (8, "äb"), (None, "lone"), (None, "same"), (9, "x" * 300_000)]


def brute(rows):
    low = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    norm = lambda t: "".join(low.get(c, c) for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[norm(t)], len(groups[norm(t)]), i == keep[norm(t)]) for i, t in rows), key=repr)


def test_decisions_match_brute_force(spark):
    got = X.decisions(docs_of(spark, ROWS)).drop("text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_small_buckets_give_the_same(spark):
    got = X.decisions(docs_of(spark, ROWS), bucket_bytes=40).drop("text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_deduplicate_keeps_one_row_of_a_group_and_all_columns(spark):
    d = docs_of(spark, ROWS)
    got = X.deduplicate(d)
    assert got.columns == d.columns
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in got.collect()), key=repr)
    assert len(kept) == 6 and (5, "same") in kept and (3, "") in kept and (None, "lone") in kept


def test_empty_table(spark):
    d = docs_of(spark, [])
    assert X.decisions(d).count() == 0 and X.deduplicate(d).count() == 0


def test_filter_resizes_and_deletes():
    rng = random.Random(1)
    digests = [rng.getrandbits(64) for _ in range(5000)]
    b = X.LiveBucket(16)
    for d in digests:
        b.add(d, {"text": str(d)})
    assert b.filter.mask + 1 >= 2048 and all(d in b.filter for d in digests)
    for d in digests[:2500]:
        assert b.remove(d, str(d))
    assert all(b.find(d, str(d)) is None for d in digests[:2500])
    assert all(b.find(d, str(d)) for d in digests[2500:]) and b.live == 2500


def test_equal_digests_of_different_texts_stay_apart():
    b = X.LiveBucket(16)
    for k in range(20):  # more than the two places of a digest hold
        assert b.find(7, f"t{k}") is None
        b.add(7, {"text": f"t{k}"})
    assert b.live == 20 and b.find(7, "t19") and b.remove(7, "t3") and b.find(7, "t3") is None and b.find(7, "t4")


def test_index_takes_batches_and_deletions(spark):
    index = X.CuckooIndex(spark, buckets=3)
    index.insert(docs_of(spark, [(1, "a"), (2, "b"), (3, "A")]))
    index.insert(docs_of(spark, [(9, "b"), (4, "c")]))
    state = {r.text: (r.keep_id, r.group_size) for r in index.live().collect()}
    assert state == {"a": (3, 2), "b": (9, 2), "c": (4, 1)}
    index.delete(docs_of(spark, [(0, "B"), (0, "never")]))
    assert {r.text for r in index.live().collect()} == {"a", "c"}
    index.insert(docs_of(spark, [(5, "b")]))
    assert {r.text: r.keep_id for r in index.live().collect()}["b"] == 5


def test_index_goes_on_in_another_session(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    index = X.CuckooIndex(spark, buckets=5, path=path)
    index.insert(docs_of(spark, [(k, f"t{k % 20}") for k in range(40)]))
    again = X.CuckooIndex(spark.newSession(), path=path)
    assert again.version == 1 and again.buckets == 5
    again.delete(docs_of(spark, [(0, "T3"), (0, "t4"), (0, "never")]))
    real = X.file_system

    def dies(session, folder):
        if folder.endswith(".tmp"):
            raise RuntimeError("host gone")
        return real(session, folder)

    monkeypatch.setattr(X, "file_system", dies)
    for _ in range(2):      # cut off before the manifest: the batch has not happened
        with pytest.raises(RuntimeError):
            again.insert(docs_of(spark, [(99, "t4"), (99, "new")]))
        assert X.CuckooIndex(spark, path=path).live().count() == 18
    monkeypatch.setattr(X, "file_system", real)
    third = X.CuckooIndex(spark, path=path)
    third.insert(docs_of(spark, [(99, "t4"), (98, "new"), (7, "t5")]))
    state = {r.text: (r.keep_id, r.group_size) for r in X.CuckooIndex(spark, path=path).live().collect()}
    want = {f"t{k}": (k + 20, 2) for k in range(20) if k not in (3, 4)} | {"t4": (99, 1), "new": (98, 1), "t5": (25, 3)}
    assert state == want
    assert len(set(third.place.values())) > 1      # buckets that no text fell in were left alone
    assert third.live().select("text_sha256").distinct().count() == 20


def test_filter_fills_well_where_low_bits_are_fixed():
    rng = random.Random(2)
    b = X.LiveBucket(16)
    for _ in range(20_000):
        d = rng.getrandbits(64) // 1024 * 1024 + 5
        b.add(d, {"text": str(d)})
    assert b.filter.mask + 1 <= 8192
