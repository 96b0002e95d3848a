"""Commit ledger: which micro-batches of which writer are whole.

A ledger is a folder of small files, two for each (writer, batch): ``begun`` is
written before the first row of the batch, ``done`` (its files and rows) after
the last one. Each is written under a hidden name and renamed, which for one file
is atomic on file systems and object stores alike. A writer commits its batches in
order, as a streaming query does, so the last ``done`` batch of each writer tells
a reader everything: what lies beyond it is not committed.

``compact`` folds a writer's entries into one file of JSON lines for many
batches, so that the folder stays small however long the writer runs; an entry
that stands in both is one entry.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..session import file_system

ENTRY = "writer string, batch bigint, rows bigint, files array<struct<name:string,rows:bigint>>"
#: Loose entries of a writer before they are folded, and the newest ones that stay loose.
FOLD_AT, KEEP_LOOSE = 1000, 10


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ------------------------------------------------------------------ files
    def _names(self, folder: str) -> list[str]:
        fs, path = file_system(self.spark, folder)
        if not fs.exists(path):
            return []
        return [s.getPath().getName() for s in fs.listStatus(path)]

    def _put(self, writer: str, name: str, lines: list[dict]) -> None:
        folder = f"{self.folder}/{writer}"
        fs, hidden = file_system(self.spark, f"{folder}/.{name}.tmp")
        _, final = file_system(self.spark, f"{folder}/{name}")
        out = fs.create(hidden, True)
        out.write(bytearray("".join(json.dumps(x) + "\n" for x in lines).encode()))
        out.close()
        if fs.exists(final):
            fs.delete(final, False)
        if not fs.rename(hidden, final):
            raise OSError(f"could not write {folder}/{name}")

    def _drop(self, writer: str, name: str) -> None:
        fs, path = file_system(self.spark, f"{self.folder}/{writer}/{name}")
        fs.delete(path, False)

    # ------------------------------------------------------------------ writers
    def begin(self, writer: str, batch: int) -> None:
        self._put(writer, f"{batch:012d}.begun", [])

    def done(self, writer: str, batch: int, rows: int, files: list[tuple[str, int]] = ()) -> None:
        """The commit: from here on the batch counts, and a retry of it is a replay."""
        entry = {"writer": writer, "batch": batch, "rows": rows, "files": [{"name": n, "rows": r} for n, r in files]}
        self._put(writer, f"{batch:012d}.done", [entry])
        self._drop(writer, f"{batch:012d}.begun")
        if sum(n.endswith(".done") for n in self._names(f"{self.folder}/{writer}")) >= FOLD_AT:
            self.compact(writer)

    def state(self, writer: str, batch: int) -> str | None:
        """``done``, ``begun`` (a run of it was cut off), or None."""
        last = self.last(writer)
        if last is not None and batch <= last:
            return "done"
        return "begun" if f"{batch:012d}.begun" in self._names(f"{self.folder}/{writer}") else None

    def knows(self, writer: str) -> bool:
        return bool(self._names(f"{self.folder}/{writer}"))

    def compact(self, writer: str, keep: int = KEEP_LOOSE) -> int:
        """Fold all but the newest entries into one file; returns how many."""
        loose = sorted(n for n in self._names(f"{self.folder}/{writer}") if n.endswith(".done"))[:-keep or None]
        if not loose:
            return 0
        rows = self.spark.read.schema(ENTRY).json([f"{self.folder}/{writer}/{n}" for n in loose]).collect()   # FOLD_AT entries at most
        lines = [r.asDict(recursive=True) for r in sorted(rows, key=lambda r: r["batch"])]
        self._put(writer, f"{loose[0][:12]}-{loose[-1][:12]}.folded", lines)
        for n in loose:
            self._drop(writer, n)
        return len(loose)

    # ------------------------------------------------------------------ readers
    def last(self, writer: str) -> int | None:
        """The last committed batch, from the names alone."""
        at = [int(n.split(".")[0].split("-")[-1]) for n in self._names(f"{self.folder}/{writer}") if n.endswith((".done", ".folded"))]
        return max(at, default=None)

    def lasts(self) -> dict[str, int]:
        """The last committed batch of every writer (one entry per streaming query)."""
        out = {w: self.last(w) for w in self._names(self.folder)}
        return {w: n for w, n in out.items() if n is not None}

    def unfinished(self) -> list[tuple[str, int]]:
        """(writer, batch) of batches that were begun and are not committed: one a writer at most."""
        out = []
        for w in self._names(self.folder):
            last = self.last(w)
            at = [int(n.split(".")[0]) for n in self._names(f"{self.folder}/{w}") if n.endswith(".begun")]
            out += [(w, b) for b in at if last is None or b > last]
        return out

    def entries(self) -> DataFrame:
        """(writer, batch, rows, files) of every committed batch."""
        if not any(self.last(w) is not None for w in self._names(self.folder)):
            return self.spark.createDataFrame([], ENTRY)
        files = self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true")
        both = [files.option("pathGlobFilter", g).json(self.folder) for g in ("*.done", "*.folded")]
        return both[0].unionByName(both[1]).dropDuplicates(["writer", "batch"])
