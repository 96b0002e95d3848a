"""Importance resampling towards a target text (hashed n-gram features).

Each text's features are all runs of 1 to ``max_n`` consecutive words; a feature
falls in the bucket of its CRC-32. The totals of the buckets over all documents
and over all target texts give each bucket a gain, a document's weight is the sum
of its features' gains, and the highest weights, each disturbed by a Gumbel
number that only its id decides, are drawn: a sample without replacement in
proportion to exp(weight / 1000).

Vocabulary by head and tail: one pass over all documents counts words (and pairs
where ``max_n`` is over 1) in a bounded table per task, and the most frequent
ones are broadcast, a word with its CRC state, a pair with its bucket. What the
head lacks takes the CRC directly; a longer run continues the state of the run
without its last word. Both ways give the same number, so the head only decides
the time that hashing takes, never a total.

Every text is read once for the head and once for its features, whose buckets
are stored (2 bytes each); totals and weights come from that table. Memory: a
task holds a batch of texts, the head (at most ``HEAD`` words and pairs) and two
arrays of ``buckets`` numbers. The driver sees the bucket totals and the head.
Ranks come from a range-partitioned sort, so no task holds all documents.

Defined cases: a null or empty text has no features and weight 0; repeated rows
are rows of their own (equal ones have equal scores and are ranked in any order);
ties go to the smaller id, a null id first; its random number is that of the id
written as the empty text. An empty table gives an empty result; an empty target
has totals of 0. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import prefix_index
from .common import staged

BUCKETS, MAX_N = 10_000, 1
MIN_WORDS, PERCENT, SEED = 20, 10, "2024"
#: Words and pairs that are broadcast at most, and that a task counts at once while it looks for them.
HEAD, COUNTED = 50_000, 400_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, runs of digits, ASCII letters and all characters beyond ASCII."""
    return _WORD.findall((text or "").encode().lower())


def pairs_of(words: list[bytes]) -> list[bytes]:
    return [b"%b %b" % p for p in zip(words, words[1:])]


def _trim(counts: Counter) -> Counter:
    """The more frequent half of the table."""
    return Counter(dict(heapq.nlargest(COUNTED // 2, counts.items(), key=lambda x: x[1])))


def head(docs: DataFrame, text_col: str = "text", max_n: int = MAX_N, size: int = HEAD) -> list[bytes]:
    """The most frequent words (and pairs): counts may miss rare ones, which costs time only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                words = words_of(text)
                for at in range(0, max(1, len(words)), COUNTED):
                    some = words[at:at + COUNTED]
                    counts.update(some)
                    if max_n > 1:
                        counts.update(pairs_of(some))
                    if len(counts) > 2 * COUNTED:
                        counts = _trim(counts)
        best = heapq.nlargest(size, counts.items(), key=lambda x: x[1])
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())],
                                             names=["feature", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "feature binary, n long")
    top = counted.groupBy("feature").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "feature").limit(size)
    return [bytes(r.feature) for r in top.collect()]


class Features:
    """Buckets of a text's features, by the head where it knows them."""

    def __init__(self, frequent: list[bytes], buckets: int = BUCKETS, max_n: int = MAX_N):
        self.buckets, self.max_n = buckets, max_n
        self.states = {w: zlib.crc32(w) for w in frequent if b" " not in w}
        self.pairs = {w: zlib.crc32(w) % buckets for w in frequent if b" " in w}

    def of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int64)
        states = list(map(self.states.get, words))
        if None in states:
            states = [zlib.crc32(w) if s is None else s for w, s in zip(words, states)]
        out = [np.array(states, np.int64) % self.buckets]
        if self.max_n > 1:
            tails = [b" " + w for w in words[1:]]
            known = list(map(self.pairs.get, pairs_of(words)))
            if self.max_n == 2:
                out.append(np.array([zlib.crc32(t, s) % self.buckets if k is None else k for t, s, k in zip(tails, states, known)], np.int64))
            else:
                run = [zlib.crc32(t, s) for t, s in zip(tails, states)]
                for n in range(2, self.max_n + 1):
                    out.append(np.array(run, np.int64) % self.buckets)
                    run = [zlib.crc32(t, s) for t, s in zip(tails[n - 1:], run)]
        return np.concatenate(out)


def features(docs: DataFrame, frequent: list[bytes], id_col: str = "doc_id", text_col: str = "text",
             buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """(id, n_words, features): each row's buckets as unsigned numbers of 2 bytes, or 4."""
    spark, kind = docs.sparkSession, "<u2" if buckets <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(frequent)
    schema = T.StructType().add("id", docs.schema[id_col].dataType).add("n_words", "long").add("features", "binary")
    held: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = held.setdefault("by", None) or Features(shared.value, buckets, max_n)
        for b in batches:
            ws = [words_of(t) for t in b.column("text").to_pylist()]
            got = [by.of(w).astype(kind).tobytes() for w in ws]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(map(len, ws), pa.int64()), pa.array(got, pa.binary())], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall in each bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for f in b.column("features"):
                n += np.bincount(np.frombuffer(f.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(n[at])], names=["bucket", "n"])

    got = found.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(doc_id, seed: str = SEED) -> int:
    """floor(1000 times) a Gumbel number that the seed and the id decide."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score)."""
    shared = found.sparkSession.sparkContext.broadcast(gain)
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    schema = T.StructType().add("id", found.schema["id"].dataType).add("n_words", "long").add("n_features", "long") \
        .add("weight", "long").add("score", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            at = [np.frombuffer(f.as_buffer(), kind) for f in b.column("features")]
            weight = [int(gain[a].sum()) for a in at]
            score = [w + gumbel(i, seed) for w, i in zip(weight, b.column("id").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), pa.array(map(len, at), pa.int64()),
                                              pa.array(weight, pa.int64()), pa.array(score, pa.int64())], names=schema.names)

    return found.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, max_n: int = MAX_N, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: str = SEED, head_size: int = HEAD) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank is null for those not
    drawn: ``percent`` of the rows that have ``min_words`` words, rounded down."""
    frequent = head(docs, text_col, max_n, head_size)
    found = staged(features(docs, frequent, id_col, text_col, buckets, max_n), "features")
    wanted = features(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), frequent, "id", "text", buckets, max_n)
    gain = gains(totals(found, buckets), totals(wanted, buckets))
    draw = found.where(F.col("n_words") >= min_words).count() * percent // 100
    may = (F.col("n_words") >= min_words).alias("may")
    order = [F.col("may").desc(), F.col("score").desc(), F.col("id").asc()]
    ranked = prefix_index(scores(found, gain, seed).select("*", may), order, out="rank")
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
