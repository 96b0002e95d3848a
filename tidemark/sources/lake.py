"""The master dataset: an append-only Parquet lake of raw tweets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RAW_LAKE, TWEET_FIELDS
from ..session import discard, folder_exists, move_folder
from .ledger import Ledger

# ISO-8601 with microseconds and a numeric UTC offset, e.g.
# 2024-01-01T00:00:00.000000+00:00 (the text form of ``ingested_at``).
INGESTED_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

LAKE_READ_OPTIONS = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true",
                     "ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}


def ingested_at(now: str | Column | None = None) -> Column:
    """Processing-time stamp as text; ``now`` pins it (tests, replays)."""
    t = F.current_timestamp() if now is None else (F.lit(now).cast("timestamp") if isinstance(now, str) else now)
    return F.date_format(t, INGESTED_PATTERN)


def to_lake_rows(df: DataFrame, now: str | Column | None = None) -> DataFrame:
    return df.select(*[F.col(c) for c in TWEET_FIELDS[:4]], F.col("retweet_count").cast("bigint"),
                     F.col("tweet_created"), ingested_at(now).alias("ingested_at"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Scan every ``*.parquet`` file below ``path`` with the fixed lake schema;
    files that vanish or are corrupt during the scan are skipped, and so are those
    of streamed micro-batches that are not committed."""
    return spark.read.schema(RAW_LAKE).options(**LAKE_READ_OPTIONS).parquet(path).where(committed_files(spark, path))


def write_raw(df: DataFrame, path: str, now: str | Column | None = None) -> None:
    """Batch append of TWEET rows (snappy Parquet, unique file names)."""
    to_lake_rows(df, now).write.mode("append").option("compression", "snappy").parquet(path)


def ledger(spark: SparkSession, path: str) -> Ledger:
    """The lake's commit ledger (a hidden folder, which Parquet readers skip)."""
    return Ledger(spark, f"{path.rstrip('/')}/_ledger")


#: Folder of a streamed micro-batch: the query's id (36 characters) and the batch in
#: its name say whether it is committed.
STREAM_FOLDER = "ledgered-{query}/batch-{batch:012d}"
_MARK, _ID, _BATCH = "/ledgered-", 36, 12


def _stream_tail(file: Column) -> Column:
    """What follows the mark of a streamed folder: ``<query>/batch-<id>/<file>``."""
    return F.substring_index(file, _MARK, -1)


def committed_files(spark: SparkSession, path: str, file: Column | None = None) -> Column:
    """Condition on a file's path: it is no part of a micro-batch that is not (yet)
    committed. A predicate on the file alone, so Spark leaves such files unread."""
    file = F.col("_metadata.file_path") if file is None else file
    tail = _stream_tail(file)
    last = {q: f"{q}/batch-{n:0{_BATCH}d}" for q, n in ledger(spark, path).lasts().items()}
    plain = F.instr(file, _MARK) == 0
    if not last:
        return plain
    upto = F.try_element_at(F.create_map(*[F.lit(x) for kv in last.items() for x in kv]), F.substring(tail, 1, _ID))
    return plain | F.coalesce(F.substring(tail, 1, _ID + len("/batch-") + _BATCH) <= upto, F.lit(False))


def plain_path(file: Column) -> Column:
    """``_metadata.file_path`` (escaped like an address) as the path that readers take."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, changed) of every committed Parquet file of the lake, at any depth,
    without opening one."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed")) \
        .where(committed_files(spark, path, F.col("file")))


def _files_of(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, rows) of the files of one micro-batch, of which there are as many as it had tasks."""
    found = spark.read.schema(RAW_LAKE).option("pathGlobFilter", "*.parquet").parquet(folder)
    got = found.groupBy(F.col("_metadata.file_name").alias("name")).count().collect()
    return sorted((r["name"], r["count"]) for r in got)


def append_raw(stream: DataFrame, path: str, checkpoint: str, now: str | Column | None = None,
               trigger: dict | None = None, query_name: str | None = None, on_step=None) -> StreamingQuery:
    """Streaming append to the lake: each micro-batch counts exactly once, even when
    a task or the driver is lost at any point, on a store with or without an atomic
    rename.

    A micro-batch is written to a hidden folder together with the list of its files
    and rows, renamed to ``ledgered-<query id>/batch-<id>`` when it is whole, and
    then entered in the lake's commit ledger. ``read_raw`` and the lake checks leave
    out what the ledger lacks. A retry goes by the ledger too: an entered batch is a
    replay; a renamed one whose files and rows are all there is only entered; one
    that is there in part (the rename was cut off where it copies) is written anew.
    So the lake stays a plain tree of Parquet files, to which ``write_raw`` may add.

    Default trigger: every 60 s (the lake's freshness bound); pass
    ``{"availableNow": True}`` to drain and stop. ``on_step(name, batch)`` is called
    after each step (``begun``, ``written``, ``moved``, ``done``)."""
    root = path.rstrip("/")
    step = on_step or (lambda name, batch: None)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        book = ledger(spark, root)
        state = book.state(query, batch_id)
        final = f"{root}/{STREAM_FOLDER.format(query=query, batch=batch_id)}"
        part, note = f"{root}/_writing-{query}-{batch_id:012d}", f"{root}/_written-{query}-{batch_id:012d}"
        if state == "done":
            discard(spark, note)
            return
        if state == "begun" and folder_exists(spark, final):
            if folder_exists(spark, note) and (files := _files_of(spark, final)) == _noted(spark, note):
                book.done(query, batch_id, sum(n for _, n in files), files)
                discard(spark, note)
                return
            discard(spark, final)
        book.begin(query, batch_id)
        step("begun", batch_id)
        to_lake_rows(batch, now).write.mode("overwrite").option("compression", "snappy").parquet(part)
        files = _files_of(spark, part)
        spark.createDataFrame(files, "name string, rows bigint").coalesce(1).write.mode("overwrite").json(note)
        step("written", batch_id)
        move_folder(spark, part, final)
        step("moved", batch_id)
        book.done(query, batch_id, sum(n for _, n in files), files)
        step("done", batch_id)
        discard(spark, note)

    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(sink)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _noted(spark: SparkSession, note: str) -> list[tuple[str, int]]:
    return sorted((r["name"], r["rows"]) for r in spark.read.schema("name string, rows bigint").json(note).collect())


def ledger_audit(spark: SparkSession, path: str) -> DataFrame:
    """Committed micro-batches whose rows in the lake differ from what the ledger
    says: (writer, batch, rows, found). Empty when all is well."""
    book = ledger(spark, path).entries().select("writer", "batch", "rows")
    file = F.col("_metadata.file_path")
    streamed = spark.read.schema(RAW_LAKE).options(**LAKE_READ_OPTIONS).parquet(path).where(F.instr(file, _MARK) > 0)
    found = streamed.groupBy(F.substring(_stream_tail(file), 1, _ID).alias("writer"),
                             F.substring(_stream_tail(file), _ID + len("/batch-") + 1, _BATCH).cast("bigint").alias("batch")) \
        .agg(F.count("*").alias("found"))
    return book.join(found, ["writer", "batch"], "left").select("writer", "batch", "rows", F.coalesce("found", F.lit(0)).alias("found")) \
        .where("rows <> found")


def file_stream(spark: SparkSession, folder: str, schema, glob: str = "*.parquet",
                max_files_per_trigger: int | None = None, fmt: str = "parquet", recursive: bool = False) -> DataFrame:
    """File-folder stream: the stand-in for a message topic in tests and a
    real source for landing folders; ``recursive`` takes files of all depths."""
    r = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(folder)
