"""Keyed upserts as merge-on-read: append-only generations of rows.

A table is a folder of generations, ``gen=<name>/bucket=<n>/*.parquet``, and a
manifest that names the live ones. An upsert writes its rows as a generation of
their own and then puts the next manifest in place, one small file that is renamed:
nothing that a reader may be scanning is replaced or removed, so a reader sees all
of an upsert or nothing, and never a missing bucket. No existing row is looked at;
which row of a key counts is decided on reading, by the greatest order key
(``arrival``), so older updates that come again never win, in whatever order the
generations were written.

``compact`` folds the live generations into one with a row for each key and puts
it in place the same way; what it replaced is removed by a later ``vacuum``, when
no reader can hold the old manifest any more. Generations carry Parquet Bloom
filters on the key: ``lookup`` reads one bucket of each generation and skips the
row groups whose filter lacks the key.

One writer per table. A retried micro-batch writes the same generation again, or
is recognised by the manifest.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, file_system
from .alerts import ARRIVAL, bucket_of, latest_per_key

#: Live generations from which on an upsert folds them first; manifests that are kept.
FOLD_AT, MANIFESTS = 32, 20
#: Distinct keys a Bloom filter of one file is sized for.
BLOOM_KEYS = 1_000_000


class Generations:
    def __init__(self, spark: SparkSession, path: str, key: str = "tweet_id", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # ------------------------------------------------------------------ manifest
    def _versions(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.path}/_manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self) -> dict:
        """``live`` generations, ``applied`` (the last batch of each writer), ``retired``
        generations with the time they were replaced, and the rows' ``schema``."""
        versions = self._versions()
        if not versions:
            return {"live": [], "applied": {}, "retired": [], "schema": None, "folds": 0}
        text = self.spark.read.text(f"{self.path}/_manifest/v{versions[-1]:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _put(self, manifest: dict) -> None:
        versions = self._versions()
        name = f"v{versions[-1] + 1 if versions else 0:012d}.json"
        fs, hidden = file_system(self.spark, f"{self.path}/_manifest/.{name}.tmp")
        _, final = file_system(self.spark, f"{self.path}/_manifest/{name}")
        out = fs.create(hidden, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(hidden, final):
            raise OSError(f"{name} of {self.path} is there already: another writer?")
        for old in versions[:-MANIFESTS]:
            fs.delete(file_system(self.spark, f"{self.path}/_manifest/v{old:012d}.json")[1], False)

    # ------------------------------------------------------------------ writing
    def _write(self, rows: DataFrame, name: str) -> None:
        bloom = {f"parquet.bloom.filter.enabled#{self.key}": "true", f"parquet.bloom.filter.expected.ndv#{self.key}": str(BLOOM_KEYS),
                 "parquet.bloom.filter.adaptive.enabled": "true"}
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key) \
            .write.mode("overwrite").options(**bloom).partitionBy("bucket").parquet(f"{self.path}/gen={name}")

    def upsert(self, updates: DataFrame, order_cols, writer: str = "unnamed", batch_id: int | None = None) -> bool:
        """Add a micro-batch of updates, reduced to the last one of each key; False if it is
        in already. Columns must be those of earlier ones; the order columns are kept
        in ``arrival``."""
        m = self.manifest()
        if batch_id is not None and m["applied"].get(writer, -1) >= batch_id:
            return False
        if len(m["live"]) >= FOLD_AT:
            self.compact()
            m = self.manifest()
        rows = latest_per_key(updates, self.key, order_cols).withColumn(ARRIVAL, F.struct(*order_cols))
        rows = rows.drop(*[c for c in order_cols if c.startswith("_")]).withColumn("bucket", bucket_of(F.col(self.key), self.buckets))
        name = f"{writer}-{batch_id:012d}" if batch_id is not None else uuid.uuid4().hex
        self._write(rows, name)
        own = T.StructType([f for f in rows.schema.fields if f.name != "bucket"])
        schema = json.loads(own.json())
        if m["schema"] is not None and [f["name"] for f in m["schema"]["fields"]] != [f["name"] for f in schema["fields"]]:
            raise ValueError(f"columns {own.names} are not those of {self.path}")
        m["live"].append(name)
        if batch_id is not None:
            m["applied"][writer] = batch_id
        m["schema"] = m["schema"] or schema
        self._put(m)
        return True

    def compact(self) -> bool:
        """Fold the live generations into one; returns whether there was anything to fold."""
        m = self.manifest()
        if len(m["live"]) < 2:
            return False
        name = f"fold-{m['folds']:012d}"
        self._write(self._latest(m).withColumn("bucket", bucket_of(F.col(self.key), self.buckets)), name)
        m["retired"] += [[g, time.time()] for g in m["live"]]
        m["live"], m["folds"] = [name], m["folds"] + 1
        self._put(m)
        return True

    def vacuum(self, older_than_s: float = 24 * 3600) -> int:
        """Remove generations that were replaced that long ago; returns how many."""
        m = self.manifest()
        old = [g for g, at in m["retired"] if at <= time.time() - older_than_s]
        if old:
            m["retired"] = [x for x in m["retired"] if x[0] not in old]
            self._put(m)
            discard(self.spark, *[f"{self.path}/gen={g}" for g in old])
        return len(old)

    # ------------------------------------------------------------------ reading
    def _rows(self, m: dict, buckets: list[int] | None = None) -> DataFrame:
        if not m["live"]:
            raise ValueError(f"{self.path} has no rows yet")
        schema = T.StructType.fromJson(m["schema"]).add("bucket", "integer")
        live = [f"{self.path}/gen={g}" for g in m["live"]]      # FOLD_AT at most
        df = self.spark.read.schema(schema).option("basePath", self.path).parquet(*live)
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    def _latest(self, m: dict, buckets=None, keys=None) -> DataFrame:
        rows = self._rows(m, buckets)
        if keys is not None:
            rows = rows.where(F.col(self.key).isin(keys))
        if len(m["live"]) == 1:
            return rows.drop("bucket", "gen")      # one row for each key
        return latest_per_key(rows.drop("bucket", "gen"), self.key, (ARRIVAL,))

    def latest(self) -> DataFrame:
        """One row for each key: the one that arrived last."""
        return self._latest(self.manifest())

    def lookup(self, *keys) -> DataFrame:
        """The rows of a few keys: their buckets only, and of those only row groups whose
        Bloom filter may have one."""
        at = self.spark.range(1).select(*[bucket_of(F.lit(k).cast("string"), self.buckets).alias(f"b{i}") for i, k in enumerate(keys)]).first()
        return self._latest(self.manifest(), sorted(set(at)), list(keys))
