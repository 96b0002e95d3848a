"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere in the
corpus goes. Rolling-hash triggers cut each text into phrases: a position's
trigger is the least 16-byte rolling hash among the next ``WINDOW`` positions,
and positions with one trigger make a phrase, which reaches LENGTH - 1 bytes into
the next ones. So every LENGTH-byte string lies in exactly one phrase, and equal
strings lie at the same distance from equal triggers. The parse is the list of a
text's phrases, the dictionary the distinct ones. The corpus order of strings is
that of the dictionary's suffixes, each standing as often as the parse has its
phrase: a suffix array of the dictionary, to depth LENGTH, whose neighbours are
equal byte for byte or not, and the parse in order of its phrases, which gives
the numbers. A string is repeated if its place in that order is shared. Deeper
order cannot matter, as no string crosses a phrase, so the parse is ordered to
the depth of one phrase.

Plan: (1) texts that stand several times go whole, and one of them goes on, so
that everything below is work on distinct texts. (2) Phrases by trigger bytes
(``CORE`` bytes from the trigger, which every string of the phrase holds), counted with
partial aggregation; only those whose trigger bytes stand twice go on. (3) Their
dictionary with counts. (4) The text of one occurrence of each dictionary phrase
that shares trigger bytes with others is fetched, and suffix arrays are built over
whole sets of such phrases, some ``BATCH`` bytes of sets at once; sets of more than ``SHARD``
phrases with one trigger are compared by a distributed count of their suffixes
instead, to the same result. (5) Repeated runs are merged per text, and only texts
that lose a part of themselves are read again. Triggers and phrases that stand very
often are joined by broadcast (at most ``TOP`` of them, whatever the data), the
others by shuffles, so no task gets all rows of one phrase.

Texts are named by two 64-bit hashes of their bytes, phrases by a hash of their
trigger bytes and one of all their bytes; the suffix arrays compare bytes.

Defined cases: null text counts as empty; texts of fewer than LENGTH bytes lose
nothing. Equal rows are repeats of each other. Ties don't arise: all copies of a
repeated string go, none is kept. Very long texts are parsed in blocks that
overlap. Null ids are carried through. An empty table gives an empty result. Only
the id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bits
from .common import staged

LENGTH = 200
WINDOW = 128  # a power of two
GRAM = 16
CORE = LENGTH - WINDOW + 1
#: Bytes of a text that are parsed at once.
BLOCK = 4 << 20
#: Phrases with one trigger that one task compares.
SHARD = 8_000
#: Bytes of phrases, in whole sets, that get a suffix array together.
BATCH = 1 << 20
#: Keys that are broadcast at most: those of over ``HOT`` rows and over 1 / TOP of all.
TOP, HOT = 100_000, 2_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _join(h: np.ndarray, other: np.ndarray, step: int, k: int) -> np.ndarray:
    """Hashes of strings from those of their first ``step`` bytes and of the rest."""
    n = len(other) - step
    out = (h[:n] * _ODD[k % 5]) ^ other[step:]
    out ^= out >> np.uint64(29)
    out *= _ODD[1]
    return out


def _powers(data: np.ndarray, top: int) -> list[np.ndarray]:
    """Rolling hashes of all strings of 1, 2, 4, ... up to ``top`` bytes."""
    out = [(data.astype(np.uint64) + np.uint64(1)) * _ODD[0]]
    while 1 << len(out) <= top and len(out[-1]) > 1 << (len(out) - 1):
        k = len(out) - 1
        out.append(_join(out[-1], out[-1], 1 << k, k))
    return out


def string_hashes(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A hash of each string of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    powers, have, h = _powers(data, length), 0, None
    for k in reversed(range(length.bit_length())):
        if length >> k & 1:
            h = powers[k] if h is None else _join(h, powers[k], have, k + 1)
            have += 1 << k
    return h[:len(data) - length + 1]


def phrases(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the positions of each phrase, and its trigger."""
    n = len(data) - LENGTH + 1
    low = np.uint64((1 << 24) - 1)
    h = _powers(np.frombuffer(data, np.uint8), GRAM)[-1]
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step < WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    trigger = (least[:n] & low).astype(np.int64)
    cuts = np.flatnonzero(trigger[1:] != trigger[:-1]) + 1
    start = np.concatenate(([0], cuts))
    return start, np.concatenate((cuts, [n])), trigger[start]


def _text_name(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("t1"), F.xxhash64(F.lit("text"), c).alias("t2")]


def _bytes(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*_text_name(text), F.encode(text, "utf-8").alias("data"))


PARSE = "core long, phrase long, t1 long, t2 long, start long, n int, size long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parse of each text: its phrases' trigger bytes and bytes (hashes), place,
    number of positions and the text's size."""
    core, own = xxhash.xxh64_intdigest, xxhash.xxh3_64_intdigest
    for b in batches:
        for t1, t2, data in zip(*(b.column(c) for c in ("t1", "t2", "data"))):
            raw = data.as_buffer()
            size = raw.size
            for at in range(0, size - LENGTH + 1, BLOCK):
                part = raw.slice(at, min(BLOCK + LENGTH - 1, size - at)).to_pybytes()
                s, e, a = phrases(part)
                m = memoryview(part)
                cores = np.array([core(m[x:x + CORE]) for x in a.tolist()], np.uint64)
                names = np.array([own(m[x:y + LENGTH - 1]) for x, y in zip(s.tolist(), e.tolist())], np.uint64)
                k = len(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cores.view(np.int64)), pa.array(names.view(np.int64)), pa.array(np.full(k, t1.as_py())),
                     pa.array(np.full(k, t2.as_py())), pa.array(s + at), pa.array((e - s).astype(np.int32)),
                     pa.array(np.full(k, size))], names=["core", "phrase", "t1", "t2", "start", "n", "size"])


def _parse_others(words: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The parse of the texts that are certainly not among the keys of the bit array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            other = np.ones(b.num_rows, bool)
            other[bits.maybe(words.value, b.column("t1").to_numpy(zero_copy_only=False).view(np.uint64))] = False
            yield from _parse(iter([b.filter(pa.array(other))]))

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the dictionary phrases that stand in each text."""
    for b in batches:
        for data, wanted in zip(b.column("data"), b.column("wanted")):
            raw, rows = data.as_buffer(), wanted.as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["core"] for r in rows], pa.int64()), pa.array([r["phrase"] for r in rows], pa.int64()),
                 pa.array([r["k"] for r in rows], pa.int64()), pa.array([r["many"] for r in rows], pa.bool_()),
                 pa.array([raw.slice(r["start"], r["n"] + LENGTH - 1).to_pybytes() for r in rows], pa.binary())],
                names=["core", "phrase", "k", "many", "data"])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The positions in order of their next ``depth`` bytes (8 at least; zeros follow the end),
    and each position's rank, which is equal where those bytes are."""
    n = len(data)
    key = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    for step in (1, 2, 4):
        key = key[:-step] << np.uint64(8 * step) | key[step:]
    key, have = key[:n], 8
    while True:
        order = np.argsort(key)
        inorder = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate(([True], inorder[1:] != inorder[:-1]))[:n])
        if have == depth:
            return order, rank
        step = min(have, depth - have)
        key = rank << np.uint64(32)
        key[:max(0, n - step)] |= rank[step:]
        have += step


def _compare_sets(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the phrase, first, last + 1) of the positions whose string stands in several
    of the phrases or twice in one. Equal strings are of one set, as they hold its trigger."""
    sizes = np.array([len(d) for d in data])
    ends = np.cumsum(sizes)
    inside = np.ones(ends[-1], bool)
    for back in range(1, LENGTH):
        inside[ends - back] = False
    order, rank = suffix_array(np.frombuffer(b"".join(data), np.uint8))
    order = order[inside[order]]
    same = rank[order][1:] == rank[order][:-1]
    twice = np.zeros(ends[-1], bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    lo, hi = _runs(twice)
    at = np.searchsorted(ends, lo, "right")
    return at, lo - (ends - sizes)[at], hi - (ends - sizes)[at]


FOUND = "core long, phrase long, lo long, hi long"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the sets of phrases with one trigger; a partition is sorted by it. Phrases that
    the parse has once are reported, as all strings of the others are repeated."""

    def done():
        at, lo, hi = _compare_sets(data)
        once = np.array(counts)[at] == 1
        at, lo, hi = at[once], lo[once], hi[once]
        return pa.RecordBatch.from_arrays([pa.array(np.array(cores)[at]), pa.array(np.array(names)[at]), pa.array(lo), pa.array(hi)],
                                          names=["core", "phrase", "lo", "hi"])

    cores, names, counts, data, size = [], [], [], [], 0
    for b in batches:
        for core, phrase, k, raw in zip(*(b.column(c).to_pylist() for c in ("core", "phrase", "k", "data"))):
            if size >= BATCH and core != cores[-1]:
                yield done()
                cores, names, counts, data, size = [], [], [], [], 0
            cores.append(core)
            names.append(phrase)
            counts.append(k)
            data.append(raw)
            size += len(raw)
    if data:
        yield done()


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for core, phrase, raw in zip(*(b.column(c).to_pylist() for c in ("core", "phrase", "data"))):
            h = string_hashes(np.frombuffer(raw, np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(h), core)), pa.array(np.full(len(h), phrase)), pa.array(np.arange(len(h))),
                 pa.array(h.view(np.int64))], names=["core", "phrase", "lo", "h"])


def _counted(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of the keys in ``counts``, with their number of rows ``k``. Rows of frequent keys
    stay where they are; as each has over 1 / TOP of the rows, at most TOP keys are broadcast."""
    least = max(HOT, rows.count() // TOP)
    hot = F.broadcast(counts.where(F.col("k") > least))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(counts.where(F.col("k") <= least), keys)
    return rows.join(hot, keys).unionByName(cold)


def _shared(dictionary: DataFrame, docs: DataFrame, text_col: str, shard: int) -> DataFrame:
    """(core, phrase, lo, hi): positions of dictionary phrases, once in the parse, whose string another place has too."""
    sets = staged(dictionary.groupBy("core").agg(F.count("*").alias("size")).where("size > 1"), "phrase_sets")
    wanted = dictionary.join(sets, "core").select("core", "phrase", "k", (F.col("size") > shard).alias("many"), "one.*")
    wanted = staged(wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("core", "phrase", "k", "many", "start", "n")).alias("wanted")),
                    "wanted_phrases")
    texts = bits.among(_bytes(docs, text_col), "t1", bits.build(wanted, "t1")).dropDuplicates(["t1", "t2"])
    strings = staged(texts.join(wanted, ["t1", "t2"]).select("data", "wanted")
                     .mapInArrow(_fetch, "core long, phrase long, k long, many boolean, data binary"), "phrase_strings")
    few = strings.where("not many").repartition("core").sortWithinPartitions("core").mapInArrow(_compare, FOUND)
    suffixes = strings.where("many").mapInArrow(_suffixes, "core long, phrase long, lo long, h long")
    twice = suffixes.groupBy("core", "h").agg(F.count("*").alias("k")).where("k > 1").select("core", "h")
    many = suffixes.join(twice, ["core", "h"], "left_semi").select("core", "phrase", "lo", (F.col("lo") + 1).alias("hi"))
    return few.unionByName(many)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {"spans": [], "n_removed": [], "n_spans": []}
        for spans in b.column("spans").to_pylist():
            got: list[list[int]] = []
            for s, e in sorted((x["s"], x["e"]) for x in spans):
                if got and s <= got[-1][1]:
                    got[-1][1] = max(got[-1][1], e)
                else:
                    got.append([s, e])
            out["spans"].append([{"s": s, "e": e} for s, e in got])
            out["n_removed"].append(sum(e - s for s, e in got))
            out["n_spans"].append(len(got))
        yield pa.RecordBatch.from_arrays(
            [b.column("t1"), b.column("t2"), b.column("size"),
             pa.array(out["spans"], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
             pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64())],
            names=["t1", "t2", "size", "spans", "n_removed", "n_spans"])


SPANS = "array<struct<s:long,e:long>>"


def _copied(docs: DataFrame, text_col: str) -> DataFrame:
    """(t1, t2, size, k) of the texts of at least LENGTH bytes that stand ``k`` > 1 times."""
    texts = _bytes(docs, text_col).where(F.length("data") >= LENGTH)
    return staged(texts.groupBy("t1", "t2").agg(F.count("*").alias("k"), F.max(F.length("data")).cast("long").alias("size"))
                  .where("k > 1"), "copied_texts")


def repeats(docs: DataFrame, text_col: str = "text", shard: int = SHARD, copied: DataFrame | None = None) -> DataFrame:
    """(t1, t2, size, spans, n_removed, n_spans) of each distinct text that loses
    bytes: maximal runs [s, e) of repeated bytes."""
    copied = _copied(docs, text_col) if copied is None else copied
    texts = _bytes(docs, text_col).where(F.length("data") >= LENGTH)
    words = bits.build(copied, "t1")
    single = texts.mapInArrow(_parse_others(texts.sparkSession.sparkContext.broadcast(words)), PARSE)
    one = bits.among(texts, "t1", words).dropDuplicates(["t1", "t2"]).mapInArrow(_parse, PARSE)
    # tables, so that texts are parsed once, and the counts are of a table's rows
    parse = staged(single.unionByName(one), "phrases")
    twice = staged(parse.groupBy("core").agg(F.count("*").alias("k")).where("k > 1"), "repeated_triggers")
    parse = staged(_counted(parse, twice, ["core"]).drop("k"), "parse")
    place = F.struct("t1", "t2", "start", "n")
    dictionary = staged(parse.groupBy("core", "phrase").agg(F.count("*").alias("k"), F.min(place).alias("one")), "dictionary")
    parse = staged(_counted(parse, dictionary.select("core", "phrase", "k"), ["core", "phrase"]), "counted_parse")
    whole = parse.where("k > 1") \
        .select("t1", "t2", "size", F.col("start").alias("s"), (F.col("start") + F.col("n") + LENGTH - 1).alias("e"))
    part = _shared(dictionary, docs, text_col, shard) \
        .join(parse.where("k = 1").select("core", "phrase", "t1", "t2", "size", "start"), ["core", "phrase"]) \
        .select("t1", "t2", "size", (F.col("start") + F.col("lo")).alias("s"), (F.col("start") + F.col("hi") + LENGTH - 1).alias("e"))
    every = copied.select("t1", "t2", "size", F.lit(0).cast("long").alias("s"), F.col("size").alias("e"))
    spans = whole.unionByName(part).unionByName(every).groupBy("t1", "t2", "size").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return staged(spans.mapInArrow(_merged, f"t1 long, t2 long, size long, spans {SPANS}, n_removed long, n_spans long"), "repeats")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kept = []
        for data, spans in zip(b.column("data"), b.column("spans").to_pylist()):
            raw, at, parts = data.as_buffer().to_pybytes(), 0, []
            for x in spans:
                parts.append(raw[at:x["s"]])
                at = x["e"]
            kept.append(b"".join([*parts, raw[at:]]))
        sha = [hashlib.sha256(k).hexdigest() for k in kept]
        yield pa.RecordBatch.from_arrays([b.column("t1"), b.column("t2"), pa.array(kept, pa.binary()), pa.array(sha)],
                                         names=["t1", "t2", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True,
                   shard: int = SHARD) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, spans, kept_sha256 and
    (``with_kept``) the kept bytes. Bytes may no longer be whole UTF-8 characters."""
    copied = _copied(docs, text_col)
    found = repeats(docs, text_col, shard, copied)
    partly = found.where("n_removed < size").select("t1", "t2", "spans")
    texts = bits.among(_bytes(docs, text_col), "t1", bits.build(partly, "t1")).dropDuplicates(["t1", "t2"])
    cut = texts.join(partly, ["t1", "t2"]).select("t1", "t2", "data", "spans") \
        .mapInArrow(_cut, "t1 long, t2 long, kept binary, kept_sha256 string")
    cut = found.select("t1", "t2", "spans", "n_removed", "n_spans").join(cut if with_kept else cut.drop("kept"), ["t1", "t2"], "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.encode(text, "utf-8")
    d = docs.select(F.col(id_col).alias("id"), *_text_name(text), F.octet_length(text).cast("long").alias("n_bytes"),
                    F.sha2(own, 256).alias("sha"), *([own.alias("data")] if with_kept else []))
    # rows of a text that stands very often go whole: they are marked by broadcast (at most TOP texts) and match nothing, spread by row
    least = max(HOT, (copied.agg(F.sum("k")).first()[0] or 0) // TOP)
    hot = F.broadcast(copied.where(F.col("k") > least).select("t1", "t2", F.col("size").alias("gone")))
    d = d.join(hot, ["t1", "t2"], "left").withColumn("t1", F.when(F.col("gone").isNull(), F.col("t1")).otherwise(F.monotonically_increasing_id())) \
        .withColumn("t2", F.when(F.col("gone").isNull(), F.col("t2")))
    d = d.join(cut, ["t1", "t2"], "left").withColumns({
        "n_removed": F.coalesce("n_removed", "gone"), "n_spans": F.coalesce("n_spans", F.when(F.col("gone").isNotNull(), F.lit(1).cast("long"))),
        "spans": F.coalesce("spans", F.when(F.col("gone").isNotNull(), F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("gone").alias("e")))))})
    none = F.col("n_removed").isNull()
    empty = hashlib.sha256(b"").hexdigest()
    out = [F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
           F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
           F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
           F.when(none, F.col("sha")).otherwise(F.coalesce("kept_sha256", F.lit(empty))).alias("kept_sha256")]
    if with_kept:
        out.append(F.when(none, F.col("data")).otherwise(F.coalesce("kept", F.encode(F.lit(""), "utf-8"))).alias("kept"))
    return d.select(*out)
