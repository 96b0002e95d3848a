"""Index of a lake's Parquet footers: what each file holds, without reading its rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lake import lake_files

#: Stores whose files a task opens by itself; others are read through Spark.
OPENED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
INDEX = "file string, columns array<string>, rows bigint, layout string, error string"
#: Footers that one task reads.
FOOTERS = 2000


def opened_by_tasks(path: str) -> bool:
    return (urlparse(path).scheme or "file") in OPENED


def _footer(uri: str) -> tuple[list[str], int]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    scheme, _, rest = uri.partition(":/") if ":/" in uri else ("file", "", uri)
    if scheme == "file":    # file:/a and file:///a alike; names are as they stand, nothing is escaped
        fs, path = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        host, _, path = rest.lstrip("/").partition("/")
        fs, _ = pafs.FileSystem.from_uri(f"{OPENED[scheme]}://{host}/")
        path = f"{host}/{path}" if OPENED[scheme] in ("s3", "gs") else f"/{path}"
    with fs.open_input_file(path) as f:
        meta = pq.ParquetFile(f).metadata
        return meta.schema.to_arrow_schema().names, meta.num_rows


def layout_of(columns: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(columns)).encode()).hexdigest()[:16]


def footer_index(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """(file, columns, rows, layout, error) of every committed file of the lake, its
    footer read in a task. A file that is no Parquet has its error and no columns."""
    found = (files if files is not None else lake_files(spark, path)).select("file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for uri in b.column("file").to_pylist():
                try:
                    columns, rows = _footer(uri)
                    out.append((uri, columns, rows, layout_of(columns), None))
                except Exception as e:  # noqa: BLE001 - reported with the file
                    out.append((uri, [], 0, "", str(e).split("\n")[0]))
            if out:
                types = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["file", "columns", "rows", "layout", "error"])

    # rows per partition are bounded by the listing's size, not by one task: paths are dealt out by hash
    parts = max(1, -(-found.count() // FOOTERS))
    return found.repartition(parts, "file").mapInArrow(run, INDEX)


def layouts(index: DataFrame) -> DataFrame:
    """(layout, columns, files, rows): one row for each set of columns in the lake."""
    return index.where("error IS NULL").groupBy("layout").agg(
        F.array_sort(F.first("columns")).alias("columns"), F.count("*").alias("files"), F.sum("rows").alias("rows"))
