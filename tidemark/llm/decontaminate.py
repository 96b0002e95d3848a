"""Benchmark decontamination with spaced seeds.

A spaced seed is a fixed mask over consecutive tokens; its hash covers only the
positions marked 1, so a substituted token at a 0 does not matter. Hashes of
every benchmark window and of every training window are joined; each hit gives
an alignment (document, item, distance), and the tokens along it are compared:
an overlap counts when some run of ``min(item tokens, WINDOW)`` aligned tokens
agrees in ``IDENTITY`` of its places. The masks are lossless for that rule: for
whole windows and for each length of shorter items, every choice of places that
may differ leaves some mask untouched somewhere, so no overlap is missed.

Plan: the benchmark's hashes go into a bit array of bounded size (see ``bits``),
whatever the benchmark's size, which is broadcast; training windows that miss it
never leave their task. The few documents with possible hits are written with
their token hashes, and their hashes meet the benchmark's in an equi-join (the
bit array only saves rows, the join decides). Verification reads those
documents, one row per (document, item).

Defined cases: null texts count as empty and match nothing. Items of fewer than
``MIN_TOKENS`` tokens are no evidence and match nothing; items shorter than
``WINDOW`` have masks of their length. Repeated documents or items match alike,
each on its own. Null ids are carried through. Empty tables give an empty result.
Only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bits
from .bits import maybe
from .common import slices, staged

#: Fixed seeds, 1: the token takes part. Together they hit each of the 78 ways to swap 2 of 13 tokens.
MASKS = ("111011111", "11110100111", "110100111011", "101111101001", "1010011100111")
WINDOW = 13
IDENTITY = 0.8
MIN_TOKENS = 5
#: Tokens of a mask for items of so many tokens.
WEIGHTS = {5: 4, 6: 4, 7: 5, 8: 6, 9: 6, 10: 6, 11: 6, 12: 7}

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(c if c in _KEEP else 32 for c in range(256))
_C1 = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words; ASCII signs part words."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def swaps(n: int) -> int:
    """How many of a window's ``n`` tokens may differ."""
    return max(k for k in range(n + 1) if n - k >= IDENTITY * n)


def untouched(mask: tuple[int, ...], n: int) -> set[tuple[int, ...]]:
    """The ways to swap ``swaps(n)`` of n tokens that leave the mask alone at some place."""
    return {w for at in range(n - mask[-1]) for w in combinations([p for p in range(n) if p - at not in mask], swaps(n))}


@lru_cache
def masks_for(n: int) -> tuple[tuple[int, ...], ...]:
    """The places of each mask for items of ``n`` tokens, ``WINDOW`` standing for longer
    ones. Short items take the mask that hits most of the ways not yet hit, until none is left."""
    if n >= WINDOW:
        return tuple(tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS)
    weight = WEIGHTS[n]
    masks = [(0, *inner, last) for last in range(weight - 1, n) for inner in combinations(range(1, last), weight - 2)]
    hit = {m: untouched(m, n) for m in masks}
    left, out = set(combinations(range(n), swaps(n))), []
    while left:
        out.append(max(masks, key=lambda m: len(hit[m] & left)))
        left -= hit[out[-1]]
    return tuple(out)


def seeds(toks: np.ndarray, places: tuple[int, ...], salt: int) -> np.ndarray:
    """The mask's hash at every position where it fits."""
    n = len(toks) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    t = toks.astype(np.uint64)
    h = np.full(n, salt + 1, np.uint64)
    for p in places:
        h = (h ^ t[p:p + n]) * _C1
        h ^= h >> np.uint64(32)
    return h


def _item_rows(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = bench.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toks = [tokens(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([t.tobytes() for t in toks], pa.binary()),
                                              pa.array([len(t) for t in toks], pa.int32())], names=["item_id", "toks", "n"])

    schema = T.StructType().add("item_id", bench.schema[id_col].dataType).add("toks", "binary").add("n", "integer")
    return d.mapInArrow(run, schema).where(F.col("n") >= MIN_TOKENS).withColumn("item", F.monotonically_increasing_id())


def _item_seeds(items: DataFrame, masks: list[tuple[int, tuple[int, ...]]]) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, raw in zip(b.column("item").to_pylist(), b.column("toks").to_pylist()):
                toks = np.frombuffer(raw, np.uint32)
                for m, (length, places) in enumerate(masks):
                    if length == min(len(toks), WINDOW):
                        h = seeds(toks, places, m)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h.view(np.int64)), pa.array([item] * len(h), pa.int64()),
                             pa.array(np.arange(len(h), dtype=np.int32))], names=["h", "item", "at"])

    return items.select("item", "toks").mapInArrow(run, "h long, item long, at int")


def _possible(docs: DataFrame, id_col: str, text_col: str, masks: list[tuple[int, tuple[int, ...]]], array: np.ndarray) -> DataFrame:
    """Documents with a window in the bit array: their tokens and those windows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(array)
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, text_key long, toks binary, hits array<struct<h:long,at:int>>"
    hit_type = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            which, toks_out, hits_out = [], [], []
            for row, text in enumerate(b.column("text").to_pylist()):
                toks, hits = tokens(text), []
                for m, (_, places) in enumerate(masks):
                    h = seeds(toks, places, m)
                    at = maybe(shared.value, h)
                    hits += [{"h": x, "at": y} for x, y in zip(h[at].view(np.int64).tolist(), at.tolist())]
                if hits:
                    which.append(row)
                    toks_out.append(toks.tobytes())
                    hits_out.append(hits)
            if which:
                kept = b.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("text_key"), pa.array(toks_out, pa.binary()),
                                                  pa.array(hits_out, hit_type)], names=["id", "text_key", "toks", "hits"])

    return d.mapInArrow(run, schema).withColumn("doc", F.monotonically_increasing_id())


def best_window(doc: np.ndarray, item: np.ndarray, distance: int) -> tuple[int, int, int]:
    """Along one alignment: (most agreeing tokens in a window, its start in the
    document, agreeing tokens altogether)."""
    s, e = max(0, distance), min(len(doc), distance + len(item))
    w = min(len(item), WINDOW)
    if e - s < w:
        return 0, s, 0
    same = np.concatenate(([0], np.cumsum(doc[s:e] == item[s - distance:e - distance])))
    run = same[w:] - same[:-w]
    k = int(run.argmax())
    return int(run[k]), s + k, int(same[-1])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, found = [], []
        for r, (dt, it, ds) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_toks", "item_toks", "distances")))):
            doc, item = np.frombuffer(dt, np.uint32), np.frombuffer(it, np.uint32)
            agree, start, total = max(best_window(doc, item, d) for d in sorted(ds))
            if agree >= IDENTITY * min(len(item), WINDOW):
                rows.append(r)
                found.append((start, agree, total, len(item)))
        if rows:
            kept = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [kept.column("id"), kept.column("text_key"), kept.column("item_id")]
                + [pa.array([f[i] for f in found], pa.int32()) for i in range(4)],
                names=["id", "text_key", "item_id", "token_start", "window_matches", "item_matches", "item_tokens"])


def overlaps(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, text_key, item_id, token_start, window_matches, item_matches, item_tokens):
    one row per document row and item that overlap."""
    items = staged(_item_rows(bench, item_col, item_text), "bench_items")
    lengths = [r["n"] for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().orderBy("n").collect()]
    masks = [(n, places) for n in lengths for places in masks_for(n)]
    hashes = staged(_item_seeds(items, masks), "bench_seeds")
    possible = staged(_possible(docs, id_col, text_col, masks, bits.build(hashes, "h", 256)), "possible_leaks")
    hits = possible.select("doc", F.explode("hits").alias("x")).select("doc", F.col("x.h").alias("h"), F.col("x.at").alias("doc_at"))
    aligned = hits.join(hashes, "h").select("doc", "item", (F.col("doc_at") - F.col("at")).alias("distance")) \
        .groupBy("doc", "item").agg(F.collect_set("distance").alias("distances"))
    pairs = aligned.join(possible.select("doc", "id", "text_key", F.col("toks").alias("doc_toks")), "doc") \
        .join(items.select("item", "item_id", F.col("toks").alias("item_toks")), "item")
    schema = T.StructType().add("id", docs.schema[id_col].dataType).add("text_key", "long") \
        .add("item_id", bench.schema[item_col].dataType)
    for c in ("token_start", "window_matches", "item_matches", "item_tokens"):
        schema = schema.add(c, "integer")
    return pairs.select("id", "text_key", "item_id", "doc_toks", "item_toks", "distances").mapInArrow(_verify, schema)


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item."""
    bad = overlaps(docs, bench, id_col, text_col, item_col, item_text) \
        .select(F.col("id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__text")), "left_anti")
