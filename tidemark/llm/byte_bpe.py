"""Byte-level BPE: encoding by overlapping chunks, decoding to raw bytes.

A text of at most ``chunk`` characters is pre-tokenised and encoded where it is
read. A longer one is cut into chunks that reach ``overlap`` characters into the
next, and the chunks are dealt out over all tasks, so that a few very long texts
do not hold the others up. Each chunk is pre-tokenised on its own. The pattern
only looks ahead, by at most ``LOOKAHEAD`` characters beyond a match, so two runs
over the same text that share one boundary share all later ones: the first
boundary of a chunk that its predecessor has too, in their common part, is where
the predecessor's pre-tokens end and its own begin. As the first chunk starts
with the text, all boundaries are those of the whole text. A text whose chunks
share no boundary somewhere (a run of letters longer than the overlap) is put
together again and pre-tokenised whole. The pieces of a text are joined in
order of their chunks.

Each pre-token is merged by ranks, its lowest pair first, and the ids of recent
ones are remembered. Decoding concatenates the bytes of the ids, without any
change, so that bytes which are no UTF-8 survive.

Memory: a task holds ``ROWS`` short texts, ``CHUNKS`` chunks or, where chunks don't
meet, one text; remembered pre-tokens are bounded by ``MEMORY``.

Defined cases: a null or empty text has no ids; repeated rows and null ids are
rows of their own; an empty table gives an empty result; other columns are not
read. ``decode`` gives null for null ids, for an id outside of the vocabulary
and for bytes that are no whole number of ids.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP = 32_768, 512
#: The pattern's alternatives decide by at most so many characters past a match's end ('re, 've, 'll).
LOOKAHEAD = 4
#: Distinct pre-tokens of each of two generations whose ids a worker remembers.
MEMORY = 200_000
#: Short texts and chunks whose Python objects a task holds at once.
ROWS, CHUNKS = 512, 32
#: Longer pre-tokens are merged with a heap, and not remembered.
LONG = 64
#: The rank of a pair that is no token.
NONE = 1 << 62

_CODECS: dict[str, "ByteBPE"] = {}


class ByteBPE:
    """Ids of pre-tokens by the ranks of a vocabulary file (base64 bytes and rank per line)."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY):
        import regex
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.parts = regex.compile(pattern).findall
        self.memory = memory
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: of all adjoining pairs that are tokens, the one of
        the lowest rank (of equal ones the first) is merged, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > LONG:
            return self._merge_long(piece)
        rank = ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i:i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) != NONE:
            at = pairs.index(low)
            parts[at:at + 2] = [both] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + both, NONE)
            if at < len(pairs):
                pairs[at] = rank(both + parts[at + 1], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list of parts."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))       # end of the part that starts at i
        before = list(range(-1, n - 1))   # start of the part before it
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of its parts has grown since
            second = end[i]
            alive[second] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _ids(self, part: str) -> bytes:
        if (ids := self.older.get(part)) is None:
            ids = array("I", self.merge(part.encode())).tobytes()
        return ids

    def encode_parts(self, parts: list[str]) -> bytes:
        """The ids of pre-tokens as little-endian unsigned 32-bit numbers."""
        if len(self.known) > self.memory:
            self.known, self.older = {}, self.known
        known = self.known
        got = list(map(known.get, parts))
        if None in got:
            for i, ids in enumerate(got):
                if ids is None:
                    if (ids := known.get(parts[i])) is None:
                        ids = self._ids(parts[i])
                        if len(parts[i]) <= LONG:
                            known[parts[i]] = ids
                    got[i] = ids
        return b"".join(got)

    def encode(self, text: str) -> bytes:
        return self.encode_parts(self.parts(text))

    def decode(self, ids: bytes | None) -> bytes | None:
        if ids is None or len(ids) % 4:
            return None
        try:
            return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()])
        except KeyError:
            return None


def codec(vocabulary: str = VOCABULARY) -> ByteBPE:
    """The worker's codec for one of the installed vocabulary files, or a path."""
    if vocabulary not in _CODECS:
        import public_tokenizers
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        _CODECS[vocabulary] = ByteBPE(path, public_tokenizers.PATTERN)
    return _CODECS[vocabulary]


def _few(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def boundaries(parts: list[str]) -> np.ndarray:
    """Ends of the pre-tokens of a chunk, in characters from its start, after a 0."""
    return np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])


def _chunks(texts: DataFrame, id_type: T.DataType, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """(uid, id, k, start, last, text, ends, head, tail): the pre-tokenised chunks of long
    texts. ``head``: boundaries that may be met from before, ``tail``: those that may be
    met by the next chunk; both in characters of the whole text."""
    cut = T.StructType().add("uid", "long").add("id", id_type).add("k", "integer").add("start", "long").add("last", "boolean").add("text", "string")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, text in enumerate(b.column("text").to_pylist()):
                starts = list(range(0, max(1, len(text) - overlap), chunk))
                one = b.slice(r, 1)
                for at in range(0, len(starts), 64):  # a few megabytes of chunks at once
                    some = starts[at:at + 64]
                    rows = pa.array([0] * len(some))
                    yield pa.RecordBatch.from_arrays(
                        [one.column("uid").take(rows), one.column("id").take(rows), pa.array(range(at, at + len(some)), pa.int32()),
                         pa.array(some, pa.int64()), pa.array([s == starts[-1] for s in some]),
                         pa.array([text[s:] if s == starts[-1] else text[s:s + chunk + overlap] for s in some])], names=cut.names)

    places = T.ArrayType(T.LongType())
    schema = T.StructType(list(cut.fields)).add("ends", "binary").add("head", places).add("tail", places)

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = codec(vocabulary).parts
        for b in _few(batches, CHUNKS):
            ends, heads, tails = [], [], []
            for text, start in zip(b.column("text").to_pylist(), b.column("start").to_pylist()):
                at = boundaries(parts(text))
                ends.append(at.astype("<u4").tobytes())
                sure = at[at <= len(text) - LOOKAHEAD]  # a match further on may go on past the chunk
                heads.append((sure[sure <= overlap] + start).tolist())
                tails.append((sure[sure >= chunk] + start).tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.binary()), pa.array(heads, pa.list_(pa.int64())),
                                              pa.array(tails, pa.list_(pa.int64()))], names=schema.names)

    return texts.mapInArrow(split, cut).repartition(F.xxhash64("uid", "k")).mapInArrow(pretokenise, schema)


def _meetings(chunks: DataFrame) -> DataFrame:
    """(uid, k, lo, hi, meets): each chunk's own span of the text, and whether the
    whole text's chunks meet."""
    c = chunks.select("uid", "k", "last", "head", "tail")
    following = c.select("uid", (F.col("k") - 1).alias("k"), F.col("head").alias("next_head"))
    met = c.join(following, ["uid", "k"], "left") \
        .select("uid", "k", "last", F.array_min(F.array_intersect("tail", "next_head")).alias("hi"))
    before = met.where(~F.col("last")).select("uid", (F.col("k") + 1).alias("k"), F.col("hi").alias("lo"))
    whole = met.groupBy("uid").agg(F.every(F.col("last") | F.col("hi").isNotNull()).alias("meets"))
    return met.join(before, ["uid", "k"], "left").join(whole, "uid").select(
        "uid", "k", F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(F.col("lo")).alias("lo"), "hi", "meets")


def _encode_spans(chunks: DataFrame, id_type: T.DataType, vocabulary: str) -> DataFrame:
    """(uid, id, k, ids) of the chunks' own spans."""
    schema = T.StructType().add("uid", "long").add("id", id_type).add("k", "integer").add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for b in _few(batches, CHUNKS):
            out = []
            for text, ends, start, lo, hi in zip(*(b.column(c).to_pylist() for c in ("text", "ends", "start", "lo", "hi"))):
                at = np.frombuffer(ends, "<u4").astype(np.int64)
                at = at[(at >= lo - start) & (at <= (len(text) if hi is None else hi - start))].tolist()
                out.append(bpe.encode_parts([text[i:j] for i, j in zip(at, at[1:])]))
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("id"), b.column("k"), pa.array(out, pa.binary())], names=schema.names)

    return chunks.select("uid", "id", "k", "start", "text", "ends", "lo", "hi").mapInArrow(run, schema)


def _encode_whole(chunks: DataFrame, id_type: T.DataType, vocabulary: str, chunk: int) -> DataFrame:
    """(id, ids) of texts whose chunks don't meet, put together again one by one."""
    schema = T.StructType().add("id", id_type).add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = codec(vocabulary), []
        for b in batches:
            for r, (text, last) in enumerate(zip(b.column("text").to_pylist(), b.column("last").to_pylist())):
                held.append(text if last else text[:chunk])
                if last:
                    ids = bpe.encode("".join(held))
                    held = []
                    yield pa.RecordBatch.from_arrays([b.column("id").slice(r, 1), pa.array([ids], pa.binary())], names=schema.names)

    return chunks.repartition("uid").sortWithinPartitions("uid", "k").select("id", "text", "last").mapInArrow(run, schema)


def _joined(spans: DataFrame, id_type: T.DataType) -> DataFrame:
    """(id, ids): the spans of each text in order. A partition's texts stream by one after the other."""
    schema = T.StructType().add("id", id_type).add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, one, held = None, None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([one, pa.array([b"".join(held)], pa.binary())], names=schema.names)

        for b in batches:
            for r, (u, ids) in enumerate(zip(b.column("uid").to_pylist(), b.column("ids").to_pylist())):
                if u != uid:
                    if held:
                        yield done()
                    uid, one, held = u, b.column("id").slice(r, 1), []
                held.append(ids)
        if held:
            yield done()

    return spans.repartition("uid").sortWithinPartitions("uid", "k").mapInArrow(run, schema)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row: id, ids (little-endian unsigned 32-bit numbers), n_tokens."""
    if not LOOKAHEAD < overlap < chunk:
        raise ValueError(f"the overlap must be over {LOOKAHEAD} and below the chunk's length")
    id_type = docs.schema[id_col].dataType
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType().add("id", id_type).add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for b in _few(batches):
            ids = [bpe.encode(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.binary())], names=schema.names)

    fits = F.char_length("text") <= chunk + overlap
    short = d.where(fits).mapInArrow(run, schema)
    long_texts = d.where(~fits).select(F.monotonically_increasing_id().alias("uid"), "id", "text")
    chunks = staged(_chunks(long_texts, id_type, vocabulary, chunk, overlap), "bpe_chunks")
    placed = chunks.join(_meetings(chunks), ["uid", "k"])
    joined = _joined(_encode_spans(placed.where("meets"), id_type, vocabulary), id_type)
    whole = _encode_whole(placed.where("not meets"), id_type, vocabulary, chunk)
    return short.unionByName(joined).unionByName(whole).select(
        F.col("id").alias(id_col), "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "bytes", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds the raw bytes of each row's ids."""
    schema = T.StructType([f for f in encoded.schema if f.name != out]).add(out, "binary")
    kept = [f.name for f in schema if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for b in _few(batches):
            raw = [bpe.decode(i) for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(raw, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)
