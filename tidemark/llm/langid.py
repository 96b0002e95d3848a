"""Language identification with language-bitmask n-gram filters.

Training counts character n-grams per language, keeps for each n-gram the
languages in which it is common enough against its commonest language, and
stores them in a bit-sliced Bloom filter: a table of language bit masks, where
each n-gram sets its language bits at ``hashes`` positions. Looking an n-gram up
is the bitwise AND of its rows: all languages that contain it, at once. A text's
per-language counts of set bits, corrected by each slice's false-positive rate,
decide; the score is the corrected share of the text's n-grams that the chosen
language contains.

The filter has a fixed number of rows, so what is collected and broadcast is
bounded (``rows`` x 8 bytes per 64 languages) whatever the corpus. It may be
trained on a bounded sample: about ``per_lang`` documents of each language,
chosen by a hash of the text.

Defined cases: null text, or text without a letter: ``und``, score 0. No learned
language (empty training table): ``und``. No evidence for any language: the one
with most training documents, score 0; ties in the corrected counts go to the
language with most training documents, then to the first by name. Null languages
are not learned. Repeated rows count as often as they occur. Very long texts are
read in blocks, whole. Only the text is read in prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, staged

N = 4
ROWS = 1 << 20
HASHES = 2
#: Documents of each language (about, chosen by hash) that the filters are trained on.
PER_LANG = 4000
#: A language holds an n-gram if its rate there is at least this part of the largest rate.
RATIO = 0.25
MIN_COUNT = 3
#: N-grams that a training task holds before it counts them.
HELD = 1 << 20
MAX_LANGS = 1024
BLOCK = 1 << 20
UND = "und"
#: A document whose score is lower gives no evidence for any learned language.
MIN_SCORE = 0.2

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def grams(text: str) -> np.ndarray:
    """64-bit hashes of the N-character n-grams of a lower-cased text; what is not a
    letter counts as one space, and the text is taken between two spaces."""
    if not text:
        return np.zeros(0, np.uint64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.where(_is_letter(cp), cp, 32)
    gap = cp == 32
    keep = ~(gap[1:] & gap[:-1])
    cp = np.concatenate(([32], cp[:1], cp[1:][keep], [32])).astype(np.uint64)
    if len(cp) < N:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(cp) - N + 1, np.uint64)
    for k in range(N):
        h = (h ^ cp[k:len(cp) - N + 1 + k]) * _C1
        h ^= h >> np.uint64(29)
    return h


_LETTER: dict[str, np.ndarray] = {}


def _is_letter(cp: np.ndarray) -> np.ndarray:
    if "t" not in _LETTER:
        _LETTER["t"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _LETTER["t"][cp]


def blocks(text: str) -> Iterator[np.ndarray]:
    for i in range(0, len(text), BLOCK):
        yield grams(text[max(0, i - N + 1):i + BLOCK])


def _slots(h: np.ndarray, rows: int, hashes: int) -> list[np.ndarray]:
    a = (h * _C2) >> np.uint64(20)
    b = ((h ^ (h >> np.uint64(31))) * _C1) >> np.uint64(20) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(rows)).astype(np.int64) for i in range(hashes)]


@dataclass
class BitmaskFilter:
    """rows x words of language bits; ``false_rate`` of each language's slice."""

    langs: list[str]
    weight: list[int]
    masks: np.ndarray
    hashes: int

    def __post_init__(self):
        rows = len(self.masks)
        bits = [(self.masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(self.langs))]
        self.false_rate = np.array([(b.sum() / rows) ** self.hashes for b in bits])

    def lookup(self, h: np.ndarray) -> np.ndarray:
        slots = _slots(h, len(self.masks), self.hashes)
        out = self.masks[slots[0]]
        for s in slots[1:]:
            out = out & self.masks[s]
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Per-language counts of the n-grams that the filters contain."""
        m = self.lookup(h)
        return np.array([int(((m[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum())
                         for i in range(len(self.langs))])

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs:
            return UND, 0.0
        if not any(map(str.isalpha, text)):
            return UND, 0.0
        hits, n = np.zeros(len(self.langs)), 0
        for h in blocks(text):
            n += len(h)
            hits += self.counts(h)
        corrected = np.clip((hits - n * self.false_rate) / (1 - self.false_rate + 1e-12), 0, n)
        best = min(range(len(self.langs)), key=lambda i: (-corrected[i], -self.weight[i], self.langs[i]))
        return self.langs[best], float(corrected[best] / n) if n else 0.0  # a text too short for an n-gram: the commonest language


def _count(batches: Iterator[pa.RecordBatch], langs: list[str], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """(g, l, n): n-grams with their language's place and counts, which are to be
    summed. About ``held`` n-grams are counted at once, however many a batch has."""
    by: dict[str, list[np.ndarray]] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        while by:
            lang, parts = by.popitem()
            g, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), pa.array(np.full(len(g), langs.index(lang), np.int32)), pa.array(n.astype(np.int64))],
                names=["g", "l", "n"])

    size = 0
    for b in slices(batches):
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
            for some in blocks(text):
                by.setdefault(lang, []).append(some)
                size += len(some)
                if size > held:
                    yield from counted()
                    size = 0
    yield from counted()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, hashes: int = HASHES,
          per_lang: int = PER_LANG, ratio: float = RATIO, min_count: int = MIN_COUNT) -> BitmaskFilter:
    """Learn the filters from the non-null texts and languages of ``docs``."""
    d = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    found = d.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: map the column to fewer before training")
    langs, weight = [r["lang"] for r in found], [r["n"] for r in found]
    words = max(1, -(-len(langs) // 64))
    masks = np.zeros((rows, words), np.uint64)
    if not langs:
        return BitmaskFilter(langs, weight, masks, hashes)
    share = F.create_map(*[F.lit(x) for k, n in zip(langs, weight) for x in (k, min(1.0, per_lang / n))])
    u = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    d = d.where(u < share[F.col("lang")])

    counts = d.mapInArrow(lambda it: _count(it, langs), "g long, l int, n long").groupBy("g", "l").agg(F.sum("n").alias("n"))
    counts = staged(counts, "gram_counts")
    size = {r["l"]: r["n"] for r in counts.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    total = F.create_map(*[F.lit(x) for i in range(len(langs)) for x in (i, float(size.get(i, 1)))])
    rate = F.col("n") / total[F.col("l")]
    best = counts.groupBy("g").agg(F.max(rate).alias("top"), F.collect_list(F.struct("l", "n", rate.alias("r"))).alias("ls"))
    held = best.select("g", F.explode(F.expr(f"filter(ls, x -> x.r >= {ratio} * top and x.n >= {min_count})")).alias("x"))
    held = held.select("g", (F.col("x.l") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, x.l % 64)").alias("bit"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column("g").to_numpy(zero_copy_only=False).view(np.uint64)
            for s in _slots(g, rows, hashes):
                yield pa.RecordBatch.from_arrays([pa.array(s), b.column("word"), b.column("bit")], names=["row", "word", "bit"])

    table = held.mapInArrow(place, "row long, word int, bit long").groupBy("row", "word").agg(F.bit_or("bit").alias("m"))
    got = table.toArrow()  # at most rows x words
    masks[got.column("row").to_numpy(), got.column("word").to_numpy()] = got.column("m").to_numpy().view(np.uint64)
    return BitmaskFilter(langs, weight, masks, hashes)


def predictor(model: BitmaskFilter, spark):
    """A column function text -> struct(lang_pred, score); the filter is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return lambda c: predict(c)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(F.col(id_col)))


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: BitmaskFilter, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    p = predictor(model, docs.sparkSession)(F.col(text_col))
    return docs.withColumn("__p", p).select(*[F.col(c) for c in docs.columns if c not in ("lang_pred", "score")],
                                            F.col("__p.lang_pred").alias("lang_pred"), F.col("__p.score").alias("score"))
