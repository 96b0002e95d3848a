"""Exact deduplication through a cuckoo-filter index.

Texts are equal when identical after lower-casing A-Z. A text's 64-bit digest
picks an index bucket; the bucket's cuckoo filter answers "not seen" for certain
or "maybe", and every "maybe" is verified against the texts stored in that
bucket, so digest collisions and filter false positives never merge different
texts. A filter that cannot place a fingerprint is rebuilt at twice the size
from the stored keys. Digests can be deleted again.

Plan: within each Arrow batch equal texts are combined (a hot text leaves a task
once per batch, not once per copy), then the combined rows go to their bucket,
which reads them as a stream and holds only distinct texts (``bucket_bytes`` of
them). Per-document flags come from a join on the text's SHA-256.

Defined cases: null text counts as empty (all empty texts are one group). A null
id is smaller than any id; a group with null ids only has keep_id null and keeps
those rows. Rows that repeat id and text share their flag in ``decisions``;
``deduplicate`` leaves one of them. An empty table gives an empty result. Only
the id and the text are read, other columns may have any name.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system
from .common import SLICE, lower_az, pieces_of, scratch_path, staged

SLOTS = 4
MAX_KICKS = 200
#: Bytes of distinct text that one bucket holds.
BUCKET_BYTES = 32 << 20

STATE, DELETE, INSERT = 0, 1, 2


class CuckooFilter:
    """16-bit fingerprints in buckets of four; partial-key cuckoo hashing."""

    def __init__(self, buckets: int = 1 << 10):
        self.mask = buckets - 1
        self.rows: list[list[int]] = [[] for _ in range(buckets)]
        self.rng = random.Random(7)

    def _places(self, digest: int) -> tuple[int, int, int]:
        fp = (digest >> 48 & 0xFFFF) or 1
        i = digest >> 16 & self.mask   # the low bits are much the same within an index bucket
        return fp, i, self._other(i, fp)

    def _other(self, i: int, fp: int) -> int:
        return (i ^ (fp * 0x5BD1E995)) & self.mask

    def insert(self, digest: int) -> bool:
        """False: no place was found; the filter lost a fingerprint and must be rebuilt."""
        fp, i, j = self._places(digest)
        for k in (i, j):
            if len(self.rows[k]) < SLOTS:
                self.rows[k].append(fp)
                return True
        k = self.rng.choice((i, j))
        for _ in range(MAX_KICKS):
            s = self.rng.randrange(SLOTS)
            fp, self.rows[k][s] = self.rows[k][s], fp
            k = self._other(k, fp)
            if len(self.rows[k]) < SLOTS:
                self.rows[k].append(fp)
                return True
        return False

    def __contains__(self, digest: int) -> bool:
        fp, i, j = self._places(digest)
        return fp in self.rows[i] or fp in self.rows[j]

    def delete(self, digest: int) -> None:
        fp, i, j = self._places(digest)
        for k in (i, j):
            if fp in self.rows[k]:
                self.rows[k].remove(fp)
                return


class LiveBucket:
    """A cuckoo filter over the live digests, with their keys and texts beside it."""

    def __init__(self, buckets: int = 1 << 10):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[dict]] = {}
        self.live = 0
        self.false_hits = 0

    def find(self, digest: int, text: str) -> dict | None:
        if digest not in self.filter:
            return None
        for entry in self.content.get(digest, ()):
            if entry["text"] == text:
                return entry
        self.false_hits += 1
        return None

    def add(self, digest: int, entry: dict) -> None:
        self.content.setdefault(digest, []).append(entry)
        self.live += 1
        if not self.filter.insert(digest):
            self.resize()

    def remove(self, digest: int, text: str) -> bool:
        entry = self.find(digest, text)
        if entry is None:
            return False
        self.content[digest].remove(entry)
        if not self.content[digest]:
            del self.content[digest]
        self.filter.delete(digest)
        self.live -= 1
        return True

    def resize(self) -> None:
        """A filter of twice the buckets (or more), filled from the stored keys."""
        size = 2 * (self.filter.mask + 1)
        while True:
            fresh = CuckooFilter(size)
            # copies of one digest beyond the slots of its two places fit no table: one fingerprint each suffices
            if all(fresh.insert(d) for d, e in self.content.items() for _ in range(min(len(e), SLOTS))):
                self.filter = fresh
                return
            size *= 2


def _order(x) -> tuple:
    return (x is not None, x)


def _merge(entry: dict, top, n: int, n_top: int) -> None:
    if _order(top) > _order(entry["top"]):
        entry["top"], entry["n_top"] = top, n_top
    elif top == entry["top"]:
        entry["n_top"] += n_top
    entry["n"] += n


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of each batch: its largest id, rows, rows with that id."""
    for b in batches:
        seen: dict[str, dict] = {}
        for row, (text, top) in enumerate(zip(b.column("text").to_pylist(), b.column("top").to_pylist())):
            if (e := seen.get(text)) is not None:
                _merge(e, top, 1, 1)
            else:
                seen[text] = {"row": row, "top": top, "n": 1, "n_top": 1}
        found, schema = list(seen.values()), _arrow(b.schema.field("top").type)
        for at in range(0, len(found), SLICE):
            some = found[at:at + SLICE]
            first = b.take(pa.array([e["row"] for e in some], pa.int64()))
            yield pa.RecordBatch.from_arrays([first.column(c) for c in ("bucket", "op", "digest", "sha", "text")]
                                             + [pa.array([e[c] for e in some], schema.field(c).type) for c in ("top", "n", "n_top")], names=schema.names)


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("bucket", pa.int64()), ("op", pa.int32()), ("digest", pa.int64()), ("sha", pa.string()),
                      ("text", pa.string()), ("top", id_type), ("n", pa.int64()), ("n_top", pa.int64())])


def _schema(id_type: T.DataType) -> T.StructType:
    return (T.StructType().add("bucket", "long").add("op", "integer").add("digest", "long").add("sha", "string")
            .add("text", "string").add("top", id_type).add("n", "long").add("n_top", "long"))


def _index(with_text: bool):
    """Reads a partition's rows (state first, then deletions, then insertions where an
    index existed before) and yields the live entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live, schema = LiveBucket(), None
        for b in batches:
            schema = _arrow(b.schema.field("top").type)
            for row in zip(*(b.column(c).to_pylist() for c in schema.names)):
                bucket, op, digest, sha, text, top, n, n_top = row
                if op == DELETE:
                    live.remove(digest, text)
                elif (e := live.find(digest, text)) is None:
                    live.add(digest, {"bucket": bucket, "op": STATE, "digest": digest, "sha": sha, "text": text,
                                      "top": top, "n": n, "n_top": n_top})
                else:
                    _merge(e, top, n, n_top)
        out: list[dict] = []
        size = 0
        for entries in live.content.values():
            for e in entries:
                size += len(e["text"]) if with_text else 100
                out.append(e if with_text else e | {"text": None})
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str, buckets: int, op: int) -> DataFrame:
    d = docs.select(F.col(id_col).alias("top"), lower_az(F.col(text_col)).alias("text"))
    d = d.select(F.xxhash64("text").alias("digest"), "text", "top")
    d = d.select(F.pmod("digest", F.lit(buckets)).alias("bucket"), F.lit(op).alias("op"), "digest",
                 F.sha2("text", 256).alias("sha"), "text", "top")
    return d.mapInArrow(_combine, _schema(docs.schema[id_col].dataType))


def bucket_count(docs: DataFrame, text_col: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    return pieces_of(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0, bucket_bytes)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(text_sha256, keep_id, group_size, n_keep): one row per distinct text."""
    n = bucket_count(docs, text_col, bucket_bytes)
    rows = _rows(docs, id_col, text_col, n, INSERT)
    live = rows.repartition(n, "bucket").mapInArrow(_index(False), rows.schema)
    return live.select(F.col("sha").alias("text_sha256"), F.col("top").alias("keep_id"),
                       F.col("n").alias("group_size"), F.col("n_top").alias("n_keep"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    d = docs.select(F.col(id_col), F.sha2(lower_az(F.col(text_col)), 256).alias("text_sha256"))
    g = groups(docs, id_col, text_col, bucket_bytes).drop("n_keep")
    return d.join(g, "text_sha256").select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns, one per group."""
    g = staged(groups(docs, id_col, text_col, bucket_bytes), "exact_groups").select(
        F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep"), F.col("n_keep").alias("__n"))

    def of(some: DataFrame) -> DataFrame:
        sha = F.sha2(lower_az(F.col(text_col)), 256)
        return docs.join(some, (sha == F.col("__sha")) & F.col(id_col).eqNullSafe(F.col("__keep")), "left_semi")

    repeated = g.where("__n > 1")
    if repeated.isEmpty():
        return of(g)
    once = of(repeated).withColumn("__sha", F.sha2(lower_az(F.col(text_col)), 256))
    return of(g.where("__n = 1")).unionByName(once.dropDuplicates(["__sha"]).drop("__sha"))


class CuckooIndex:
    """The index kept between batches and sessions: live entries by bucket in Parquet.

    A batch reads and writes only the buckets that its texts fall in, as a version of
    their own; a manifest, written last and in one piece, says in which version each
    bucket stands now. An index opened on a path goes on from the newest manifest
    there; a batch that was cut off has none, and its folder is written again. One
    writer at a time.

    ``insert`` adds texts (a text already live only grows its count), ``delete``
    removes live digests of the given texts, ``live`` is the current content."""

    def __init__(self, spark: SparkSession, buckets: int = 64, id_type: T.DataType | None = None,
                 path: str | None = None):
        self.spark = spark
        self.path = (path or scratch_path(spark, "cuckoo")).rstrip("/")
        self.schema = _schema(id_type or T.LongType())
        self.version, self.place, self.buckets = 0, {}, buckets
        fs, folder = file_system(spark, self.path)
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        if done := sorted(int(n[1:-9]) for n in names if n.startswith("v") and n.endswith(".manifest")):
            found = json.loads(spark.read.text(f"{self.path}/v{done[-1]}.manifest", wholetext=True).first()[0])
            self.version, self.buckets = done[-1], found["buckets"]
            self.place = {int(b): v for b, v in found["place"].items()}

    def _state(self, buckets=None) -> DataFrame:
        """The live entries of these buckets, or of all, from the versions they stand in."""
        by_version: dict[int, list[str]] = {}
        for b, v in self.place.items():
            if buckets is None or b in buckets:
                by_version.setdefault(v, []).append(f"{self.path}/v{v}/bucket={b}")
        out = self.spark.createDataFrame([], self.schema)
        for v, folders in by_version.items():
            out = out.unionByName(self.spark.read.schema(self.schema).option("basePath", f"{self.path}/v{v}").parquet(*folders))
        return out

    def _apply(self, rows: DataFrame) -> None:
        rows, version = staged(rows, "cuckoo_batch"), self.version + 1
        touched = {r[0] for r in rows.select("bucket").distinct().collect()}     # at most ``buckets``
        every = self._state(touched).unionByName(rows).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "op")
        every.mapInArrow(_index(True), self.schema).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v{version}")
        fs, folder = file_system(self.spark, f"{self.path}/v{version}")
        filled = {int(n.partition("=")[2]) for x in fs.listStatus(folder) if (n := x.getPath().getName()).startswith("bucket=")}
        place = {b: v for b, v in self.place.items() if b not in touched} | {b: version for b in filled}
        _, hidden = file_system(self.spark, f"{self.path}/.v{version}.tmp")
        _, final = file_system(self.spark, f"{self.path}/v{version}.manifest")
        out = fs.create(hidden, True)
        out.write(bytearray(json.dumps({"buckets": self.buckets, "place": place}).encode()))
        out.close()
        if not fs.rename(hidden, final):
            raise OSError(f"version {version} of {self.path} is there already: another writer?")
        self.version, self.place = version, place

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self._apply(_rows(docs, id_col, text_col, self.buckets, INSERT))

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self._apply(_rows(docs, id_col, text_col, self.buckets, DELETE))

    def live(self) -> DataFrame:
        return self._state().select(F.col("sha").alias("text_sha256"), F.col("top").alias("keep_id"),
                                    F.col("n").alias("group_size"), "text")
