"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Fingerprints are 64-bit majority votes over XXH64 of the text's word shingles.
Two fingerprints link at ``radius`` or fewer differing bits; links join texts
into components. Every pair that can link is compared: distinct fingerprints are
sorted into classes by the population counts of their four 16-bit quarters,
classes are cut into tiles of about ``TILE`` fingerprints, and each pair of
tiles is compared whole, block by block, with numpy exclusive-or and bit counts. A pair of tiles
is skipped when their population counts differ by more than the radius (summed
over the quarters, which is never more than the number of differing bits), so
no link is lost.

A tile pair returns a spanning forest of its links, not the links themselves, so
a group of k near copies costs at most k rows per tile. Identical fingerprints
are one fingerprint; the documents of a hot fingerprint meet it again in a join
that the adaptive skew join splits.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and links like any other; fewer words than the shingle length make one
shingle. Null ids never become a component's id unless all ids of it are null
(component_id null). Rows that repeat an id and text have the same component. An
empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, slices, staged

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints in a tile, about: a class below that is one tile, so that a fingerprint
#: goes to one tile of each neighbouring class; and those compared at once within a task.
TILE, BLOCK = 1 << 16, 2048
QUARTERS, BITS = 4, 16
CLASSES = (BITS + 1) ** QUARTERS
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The text's fingerprint as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        raw = b"".join([xxhash.xxh64_digest(b" ".join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + CHUNK))])
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_key, fp): fp as a signed long, text_key a hash of the text."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_key"), pa.array(fp)], names=["id", "text_key", "fp"])

    schema = T.StructType().add("id", docs.schema[id_col].dataType).add("text_key", "long").add("fp", "long")
    return d.mapInArrow(run, schema)


def _class():
    """The class of a fingerprint: its quarters' population counts as digits."""
    c = F.lit(0)
    for q in range(QUARTERS):
        part = F.shiftrightunsigned("fp", BITS * q).bitwiseAND(F.lit((1 << BITS) - 1))
        c = c * (BITS + 1) + F.bit_count(part)
    return c.cast("int")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    return [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]


def _digits(c: np.ndarray) -> np.ndarray:
    return np.stack([c // (BITS + 1) ** (QUARTERS - 1 - q) % (BITS + 1) for q in range(QUARTERS)], axis=1)


def _deal(tiles_of: np.ndarray, radius: int):
    """Send every fingerprint, by its class and hash, to each pair of tiles that it takes part in."""
    base = np.array([(BITS + 1) ** (QUARTERS - 1 - q) for q in range(QUARTERS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            fp, cls, h = (b.column(c).to_numpy() for c in ("fp", "cls", "h"))
            own, digits = (cls.astype(np.int64) << 32) + h % tiles_of[cls], _digits(cls)
            for d in _offsets(radius):
                there = digits + np.array(d)
                ok = ((there >= 0) & (there <= BITS)).all(axis=1)
                other = np.where(ok, there @ base, 0)
                n = np.where(ok, tiles_of[other], 0)
                if not n.any():
                    continue
                at_row = np.repeat(np.arange(len(fp)), n)
                nth = np.arange(len(at_row)) - np.repeat(np.cumsum(n) - n, n)
                mine, theirs = own[at_row], (other[at_row].astype(np.int64) << 32) + nth
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(mine, theirs)), pa.array(np.maximum(mine, theirs)),
                     pa.array((mine > theirs).astype(np.int8)), pa.array(fp[at_row])], names=["lt", "rt", "side", "fp"])

    return run


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect n nodes as (i, j) do: each node with the first of its component."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    linked = np.flatnonzero(label != np.arange(n))
    return label[linked], linked


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what is within the radius between two tiles, or
    within one: each fingerprint with the first of its local component. Tiles are
    compared block by block, and what a block finds is reduced to a forest at once, so
    that a dense group never costs more than its members."""
    nodes = left if right is None else np.concatenate([left, right])
    cols, shift = (left, 0) if right is None else (right, len(left))
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(left), block):
        some = left[at:at + block]
        for to in range(at if right is None else 0, len(cols), block):
            others = cols[to:to + block]
            a, b = np.nonzero(np.bitwise_count(some[:, None] ^ others[None, :]) <= radius)
            if not len(a):
                continue
            # both blocks side by side; a block with itself gives links in both directions, and of each to itself
            x, y = _spanning(len(some) + len(others), a, b + len(some)) if to + shift != at else _spanning(len(some), a, b)
            if to + shift != at:
                x, y = (np.where(v < len(some), v + at, v - len(some) + to + shift) for v in (x, y))
            else:
                x, y = x + at, y + at
            i.append(x)
            j.append(y)
    x, y = _spanning(len(nodes), np.concatenate(i), np.concatenate(j))
    return nodes[x], nodes[y]


def _compare(radius: int):
    def links(lt, rt, side, fp):
        cuts = np.flatnonzero((np.diff(lt) != 0) | (np.diff(rt) != 0)) + 1
        a, b = [], []
        for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(lt)]))):
            if lt[s] == rt[s]:
                x, y = _forest(fp[s:e], None, radius)
            else:
                k = s + int(np.searchsorted(side[s:e], 1))
                if k == s or k == e:
                    continue
                x, y = _forest(fp[s:k], fp[k:e], radius)
            a.append(x)
            b.append(y)
        a, b = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the tile pair that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("lt", "rt", "side")]
            cols.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield links(*(c[:cut] for c in cols))
            held = [c[cut:] for c in cols]
        if held is not None:
            yield links(*held)

    return run


def tile_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: links that connect exactly what
    pairs within the radius connect."""
    d = fps.select("fp", _class().alias("cls"))
    tiles_of = np.zeros(CLASSES, np.int64)
    for r in d.groupBy("cls").count().collect():  # at most CLASSES rows
        tiles_of[r["cls"]] = -(-r["count"] // tile)
    many = d.sparkSession.sparkContext.broadcast(tiles_of)

    d = d.withColumn("h", F.shiftrightunsigned(F.xxhash64("fp"), 1))
    dealt = d.mapInArrow(lambda it: _deal(many.value, radius)(it), "lt long, rt long, side byte, fp long")
    return dealt.repartition("lt", "rt").sortWithinPartitions("lt", "rt", "side") \
        .mapInArrow(_compare(radius), "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """One row per document: id, text_key, fingerprint (hex), component_id."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("first")), "distinct_fingerprints")
    roots = connected_components(tile_links(distinct.select("fp"), radius), "a", "b")
    rooted = staged(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    low = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component_ids")
    named = staged(rooted.join(low, "root").select("fp", "component_id"), "components")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "text_key",
                                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those whose id is the
    component's (one document; rows that share that id and text share its fate)."""
    c = components(docs, id_col, text_col, shingle, radius)
    stay = c.where(F.col(id_col).eqNullSafe(F.col("component_id"))) \
        .select(F.col(id_col).alias("__id"), F.col("text_key").alias("__text")).distinct()
    return docs.join(stay, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__text")), "left_semi")
