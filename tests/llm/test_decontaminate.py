from itertools import combinations

import numpy as np

from tidemark.llm import decontaminate as D

from .conftest import docs_of, with_clash

ITEM = "what is the largest city in the northern part of the old country by the sea"
WORDS = ITEM.split()


def bench(spark, rows):
    return with_clash(spark.createDataFrame(rows, "item_id long, text string"))


def plain(docs, items):
    """Every alignment, compared place by place."""
    out = set()
    for i, t in docs:
        doc = D.tokens(t)
        for k, u in items:
            item = D.tokens(u)
            if len(item) < D.MIN_TOKENS:
                continue
            w = min(len(item), D.WINDOW)
            for d in range(-len(item), len(doc)):
                s, e = max(0, d), min(len(doc), d + len(item))
                if e - s >= w:
                    same = np.concatenate(([0], np.cumsum(doc[s:e] == item[s - d:e - d])))
                    if (same[w:] - same[:-w]).max() >= D.IDENTITY * w:
                        out.add((i, k))
    return sorted(out, key=repr)


def found(spark, docs, items):
    return sorted({(r.id, r.item_id) for r in D.overlaps(docs_of(spark, docs), bench(spark, items)).collect()}, key=repr)


def test_substitutions_punctuation_and_edges(spark):
    swapped = WORDS.copy()
    swapped[5] = swapped[10] = "other"
    docs = [(1, "Intro: " + ITEM.upper() + "! end"), (2, "before " + " ".join(swapped) + " after"), (3, " ".join(WORDS[2:9])),
            (4, None), (5, ""), (6, "what is the old country"), (None, ITEM), (8, "w " * 50_000 + ITEM), (1, "clean text"), (9, ITEM), (9, ITEM)]
    items = [(10, ITEM), (11, None), (12, ""), (13, "too short"), (14, "exactly six words are in here"), (10, ITEM)]
    assert found(spark, docs, items) == [(1, 10), (2, 10), (8, 10), (9, 10), (None, 10)]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, [(1, "see: exactly six words ARE in here.")], items) == [(1, 14)]


def test_masks_hit_every_admitted_swap_of_every_length():
    for n in range(D.MIN_TOKENS, D.WINDOW + 1):
        k = D.swaps(n)
        assert n - k >= D.IDENTITY * n > n - k - 1
        for places in combinations(range(n), k):
            assert any(all(at + p not in places for p in m) for m in D.masks_for(n) for at in range(n - m[-1])), (n, places)


def test_swaps_at_any_place_are_found(spark):
    items, docs = [], []
    for n in range(D.MIN_TOKENS, 16):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for places in combinations(range(n), min(D.swaps(n), 2)):
            docs.append((n, "some words " + " ".join("other" if i in places else w for i, w in enumerate(words)) + " at the end " + "_".join(map(str, places))))
    rows = D.overlaps(docs_of(spark, docs), bench(spark, items)).collect()
    assert all(r.id == r.item_id for r in rows)
    assert sorted(r.id for r in rows) == sorted(i for i, t in docs if plain([(i, t)], [x for x in items if x[0] == i]))


def test_decontaminate_drops_only_the_rows_that_overlap(spark):
    d = docs_of(spark, [(1, ITEM), (1, "clean text"), (2, None), (None, ITEM)])
    got = D.decontaminate(d, bench(spark, [(1, ITEM)]))
    assert got.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == [(1, "clean text"), (2, None)]


def test_empty_tables(spark):
    assert found(spark, [], [(1, ITEM)]) == found(spark, [(1, ITEM)], []) == []


def test_documents_match_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert (got := found(spark, docs, items)) == plain(docs, items) and got
