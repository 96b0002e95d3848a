"""Best-fit packing of token sequences, certified by lower bounds.

Documents are tokenised once into a table of pieces (a document longer than the
capacity is cut into full pieces, its first piece may be shorter). Each partition
of that table packs its pieces by best-fit decreasing and compares its number of
bins with a lower bound from dual feasible functions: where both agree the
packing is certified and can't be beaten by that partition alone. Full bins
stay. Every partition that still has room in some bins hands the documents of
those bins over; they are exchanged by hash among fewer partitions and packed
again. This ends when the bins over all partitions meet the lower bound of the
whole table, when one partition held the whole exchange, or after ``ROUNDS``.

Memory: a task holds the lengths of its pieces, never their tokens, and a bin
search is a bit scan over at most ``capacity`` room sizes. An exchange partition
takes about ``EXCHANGE`` pieces. The driver sees one histogram of at most
``capacity`` lengths per round and the counts of bins.

Defined cases: a null or empty text is the end token alone. Repeated rows and
ties are pieces of their own. Null ids are carried through. An empty table gives
an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces_of, slices, staged

CAPACITY = 1024
END = 2
ROUNDS = 4
EXCHANGE = 100_000
#: Distinct words of each of two generations whose ids a worker remembers.
MEMORY = 250_000
VOCABULARY = "byte_bpe_50k.json"

_GAPS = re.compile(r"\s\s")
_TOKENIZERS: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """Ids of a byte-level BPE file, remembering the ids of words.

    Such a vocabulary parts a text before every single space that has other
    characters on both sides, so a text without adjoining white space is the sum
    of its space-parted words; other texts, and those that hold a special token's name, go to the tokenizer whole. A full stop
    or comma behind letters is a part of its own, so such a word is that of the
    letters and the sign. Of two generations of ``memory`` words the older goes."""

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.inner = Tokenizer.from_file(path)
        self.special = [t.content for t in self.inner.get_added_tokens_decoder().values()]
        self.memory = memory
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.signs = {c: self._whole(c) for c in ".,"}
        self.quick = _same_vocabulary(self.inner, path)
        byte_names = [self.inner.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(128))]
        self.names = {i: c for i, c in enumerate(byte_names) if len(c) == 1}

    def _whole(self, text: str) -> bytes:
        return array("I", self.inner.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word with the space before it."""
        if (ids := self.older.get(word)) is not None:
            return ids
        if self.quick is not None:
            return array("I", self.quick.encode_ordinary(" " + word)).tobytes()
        if word.isascii() and word.isalpha():  # one part, whose characters stand for themselves
            return array("I", [t.id for t in self.inner.model.tokenize(self.names[32] + word)]).tobytes()
        if word[-1:] in self.signs and (stem := word[:-1]).isascii() and stem.isalpha():
            if (ids := self.words.get(stem)) is None:
                ids = self.words[stem] = self._word(stem)
            return ids + self.signs[word[-1]]
        return self._whole(" " + word)

    def encode_bytes(self, text: str) -> bytes:
        """The ids as native unsigned 32-bit numbers."""
        if not text or _GAPS.search(text) or any(t in text for t in self.special):
            return self._whole(text)
        head, *words = text.split(" ")
        if len(self.words) > self.memory:
            self.words, self.older = {}, self.words
        known = self.words
        got = list(map(known.get, words))
        if None in got:
            for i, ids in enumerate(got):
                if ids is None:
                    if (ids := known.get(words[i])) is None:
                        ids = known[words[i]] = self._word(words[i])
                    got[i] = ids
        return self._whole(head) + b"".join(got)

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_bytes(text)).tolist()


def _same_vocabulary(inner, path: str):
    """An encoder of the file's ranks (same name, ``.tiktoken``), if there is one that
    gives every token the tokenizer's id: the two then agree on every text that holds
    no special token's name, and it takes a quarter of the time for single words."""
    ranks_path = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks_path):
        return None
    import base64

    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    special = {t.content for t in inner.get_added_tokens_decoder().values()}
    named = {t: i for t, i in inner.get_vocab().items() if t not in special}
    names = _byte_names()
    if {"".join(names[b] for b in t): r for t, r in ranks.items()} != named:
        return None
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    ones of Latin-1 for themselves, the others for those from 256 on, in order."""
    out, more = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, a shorter one first."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    out = [(0, head)] if head else []
    return out + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): ids as little-endian unsigned 32-bit numbers."""
    schema = T.StructType().add("id", docs.schema[id_col].dataType).add("piece", "integer").add("start", "long") \
        .add("length", "long").add("ids_crc32", "long").add("ids", "binary")
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(vocabulary_path(vocabulary))
        last = array("I", [end]).tobytes()
        for b in slices(batches):
            rows, out = [], []
            for r, text in enumerate(b.column("text").to_pylist()):
                raw = tok.encode_bytes(text or "") + last
                for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                    part = raw[4 * s:4 * (s + n)]
                    rows.append(r)
                    out.append((k, s, n, zlib.crc32(part), part))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(rows))] + [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=schema.names)
        tok.older = {}  # a worker that goes on to other work holds one generation

    return d.mapInArrow(run, schema)


def lower_bound(histogram: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that pieces of these lengths need at least (``histogram[n]``: pieces of n):
    the best of the capacity bound and two families of dual feasible functions."""
    x = np.arange(len(histogram))
    total = lambda sizes, room: -(-int((histogram * sizes).sum()) // room)
    best = total(x, capacity)
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        best = max(best, total(np.where(whole, k * x, (k + 1) * x // capacity * capacity), k * capacity))
    above = np.cumsum(histogram[::-1])[::-1]
    weight = np.cumsum(histogram * x)
    for eps in range(1, capacity // 2 + 1):  # long ones count as full bins, those under eps as nothing
        big = int(above[capacity - eps + 1]) if capacity - eps + 1 < len(above) else 0
        mid = int(weight[capacity - eps] - weight[eps - 1])
        best = max(best, big - (-mid // capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each piece's bin and offset, and the room left in each bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, room = 0, []  # rooms: bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(0)
        bins[i], offsets[i] = b, capacity - r
        room[b] = left = r - n
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(room, np.int64)


def _pack(capacity: int):
    """Packs a partition's pieces. ``bin``: the uid of the bin's first piece; ``room``
    is what the bin has left; ``certified``: the partition's bins meet its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, length = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in batches:
            uid.append(b.column("uid").to_numpy(zero_copy_only=False))
            length.append(b.column("length").to_numpy(zero_copy_only=False))
        uid, length = np.concatenate(uid), np.concatenate(length)
        order = np.argsort(uid, kind="stable")  # the same packing whatever order the shuffle brings
        uid, length = uid[order], length[order]
        bins, offsets, room = best_fit(length, capacity)
        certified = len(room) == lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        first = np.zeros(len(room), np.int64)
        first[bins[offsets == 0]] = uid[offsets == 0]
        for at in range(0, len(uid), 10_000):
            s = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[s]), pa.array(length[s]), pa.array(first[bins[s]]), pa.array(offsets[s]),
                 pa.array(room[bins[s]]), pa.array(np.full(len(uid[s]), certified))],
                names=["uid", "length", "bin", "offset", "room", "certified"])

    return run


PACKED = "uid long, length long, bin long, offset long, room long, certified boolean"


def pack(lengths: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, exchange: int = EXCHANGE) -> tuple[DataFrame, dict]:
    """(uid, bin, offset, certified) for a stored table (uid, length) with unique uids,
    ``certified`` if the bin's partition met its own bound when it was packed; and what
    was certified altogether: bins, lower bound, rounds, bins of certified partitions."""
    histogram = np.zeros(capacity + 1, np.int64)
    for r in lengths.groupBy("length").count().collect():  # at most capacity rows
        histogram[r["length"]] = r["count"]
    bound, out, final, certain, todo, parts, held = lower_bound(histogram, capacity), [], 0, 0, lengths, 0, None
    for k in range(rounds):
        packed = staged(todo.mapInArrow(_pack(capacity), PACKED), "packed")
        full, some, loose, sure = packed.agg(
            F.count(F.when(F.expr("room = 0 and offset = 0"), 1)), F.count(F.when(F.expr("room > 0 and offset = 0"), 1)),
            F.count(F.when(F.expr("room > 0"), 1)), F.count(F.when(F.expr("certified and offset = 0"), 1))).first()
        if held and full + some > held[1]:  # the exchange saved no bin: what it took apart stays as it was
            out.append(held[0])
            final += held[1]
            break
        certain += sure
        if final + full + some <= bound or parts == 1 or k == rounds - 1:
            out.append(packed)
            final += full + some
            break
        out.append(packed.where("room = 0"))
        final += full
        held = packed.where("room > 0"), some
        parts = pieces_of(loose, exchange)
        todo = held[0].select("uid", "length").repartition(parts, F.xxhash64("uid", F.lit(k)))
    placed = out[0]
    for d in out[1:]:
        placed = placed.unionByName(d)
    return placed.select("uid", "bin", "offset", "certified"), {"bins": final, "lower_bound": bound, "rounds": len(out), "certified": certain}


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, ids, sequence_id, offset;
    certified (its sequence comes from a partition whose number of sequences met the
    lower bound of its pieces), and, alike in all rows, sequences and lower_bound: how
    many sequences there are and how many there must be at least."""
    stored = staged(pieces(docs, id_col, text_col, capacity, end, vocabulary)
                    .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed, total = pack(stored.select("uid", "length"), capacity)
    return stored.join(placed, "uid").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "ids",
        F.col("bin").alias("sequence_id"), "offset", "certified", F.lit(total["bins"]).cast("long").alias("sequences"),
        F.lit(total["lower_bound"]).cast("long").alias("lower_bound"))
