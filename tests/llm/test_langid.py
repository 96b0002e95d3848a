import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid as L

from .conftest import with_clash

TEXTS = [(1, "the cat and the dog went over there", "en"), (2, "der hund und die katze gingen über", "de"),
         (3, "the house and the tree", "en"), (4, "das haus und der baum", "de"), (5, None, "en"), (6, "nur text", None)] * 4


def frame(spark, rows):
    return with_clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_defined_cases(spark):
    model = L.train(frame(spark, TEXTS))
    assert model.langs == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(frame(spark, [
        (1, None, "en"), (2, "", "en"), (3, "123 !!", "en"), (4, "the dog and the house", "de"), (5, "der baum und das haus", None),
        (6, "qqqqzzz", "en"), (7, "the cat " * 300_000, None)]), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[5][0] == "de" and got[7][0] == "en"
    assert got[6] == ("de", 0.0)  # no evidence: a tie in weight goes to the first name
    assert all(0 <= s <= 1 for _, s in got.values())


def test_one_letter_has_a_language(spark):
    model = L.train(frame(spark, TEXTS + [(7, "noch ein satz", "de")] * 3))
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(frame(spark, [(1, "a", None), (2, "中", None), (3, "1", None), (4, " é ", None)]), model).collect()}
    assert got[1] == got[2] == ("de", 0.0) and got[3] == ("und", 0.0) and got[4][0] in model.langs


def plain_prediction(model, sets, text):
    """The same decision from plain sets of n-grams, without a Bloom filter."""
    if text is None or not any(map(str.isalpha, text)):
        return None
    grams = [g for h in L.blocks(text) for g in h.tolist()]
    hits = [sum(g in s for g in grams) for s in sets]
    return model.langs[min(range(len(sets)), key=lambda i: (-hits[i], -model.weight[i], model.langs[i]))]


def test_predictions_against_plain_sets(spark, sf):
    """Filters that hold exactly the grams of the languages' texts decide as sets of them do."""
    docs = [r for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.lang]
    langs = sorted({r.lang for r in docs})
    sets = [{g for r in docs if r.lang == l and r.doc_id % 3 and r.text for h in L.blocks(r.text) for g in h.tolist()} for l in langs]
    masks = np.zeros((1 << 21, 1), np.uint64)
    for i, s in enumerate(sets):
        for slot in L._slots(np.array(sorted(s), np.uint64), len(masks), 3):
            np.bitwise_or.at(masks[:, 0], slot, np.uint64(1 << i))
    model = L.BitmaskFilter(langs, [len(s) for s in sets], masks, 3)
    asked = [r.text for r in docs if not r.doc_id % 3 and r.text]
    same = [model.predict(t)[0] == plain_prediction(model, sets, t) for t in asked if plain_prediction(model, sets, t)]
    assert len(same) > 20 and sum(same) >= 0.99 * len(same)


def test_empty_training_and_empty_table(spark):
    model = L.train(frame(spark, []))
    assert model.predict("some text") == ("und", 0.0)
    assert L.identify(frame(spark, []), model).count() == 0


def test_filter_answers_hold_every_inserted_gram_and_the_correction_holds():
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    masks = np.zeros((1 << 13, 1), np.uint64)
    for s in L._slots(grams[:2000], 1 << 13, 2):
        masks[s, 0] |= np.uint64(1)
    f = L.BitmaskFilter(["a", "b"], [1, 1], masks, 2)
    assert f.counts(grams[:2000])[0] == 2000 and f.counts(grams)[1] == 0
    wrong = f.counts(grams[2000:])[0]  # only false positives
    assert wrong > 0 and abs(wrong - 2000 * f.false_rate[0]) < 5 * np.sqrt(wrong) + 5


def test_blocks_hold_the_grams_of_the_whole_text(monkeypatch):
    text = "abcdefghij" * 30
    whole = set(L.grams(text).tolist())
    monkeypatch.setattr(L, "BLOCK", 64)
    parts = set(np.concatenate(list(L.blocks(text))).tolist())
    assert whole <= parts


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf_dir):
    from tidemark.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op9_language_id"](spark, sf_dir).join(docs, "doc_id").where("held_out and lang is not null")
    n, right = got.agg(F.count("*"), F.count(F.when(F.col("lang") == F.col("lang_pred"), 1))).first()
    assert n > 200 and right / n > 0.98


def test_counting_holds_few_ngrams_at_once(monkeypatch):
    import pyarrow as pa
    sizes, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda a, **kw: sizes.append(len(a)) or unique(a, **kw))
    texts = [(f"ein satz mit dem wort {i % 7} und {'x' * (i % 5)}", ("de", "en")[i % 2]) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*texts)], names=["text", "lang"])
    by_held = []
    for held in (500, 1 << 30):
        sums = {}
        for b in L._count(iter([batch]), ["de", "en"], held):
            for r in b.to_pylist():
                sums[r["g"], r["l"]] = sums.get((r["g"], r["l"]), 0) + r["n"]
        by_held.append((sums, max(sizes)))
        sizes.clear()
    assert by_held[0][0] == by_held[1][0]
    assert by_held[0][1] <= 600 < by_held[1][1]
