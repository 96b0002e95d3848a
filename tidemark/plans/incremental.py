"""Incremental batch layer.

The batch layer's result is a function of *all* lake rows, but every metric
is algebraic, so it can be kept as per-(hour, key) partials and updated with
only the files that arrived since the last cycle:

* new lake files are found by a file stream over the lake folder run with
  ``availableNow`` — its checkpoint records which files were processed, so
  each file is folded in exactly once, even across restarts;
* each micro-batch aggregates its rows to partials (partial aggregation
  before the shuffle, as everywhere), reads only the month partitions of the
  partials table it touches, merges, and rewrites those months;
* a retried micro-batch is recognised by ``last_batch`` and skipped, so the
  partials never count a file twice.

A cycle then costs O(new data + touched months of partials) instead of
O(whole lake); the partials table holds (hours × keys) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_time
from ..operators.metrics import TWEET_SPEC, MetricSpec, combine_partials, finish_partials, partial_metrics
from ..operators import quality as Q
from ..operators.tables import DYNAMIC_OVERWRITE, append_rows, finish_overwrite, overwrite_safely, table_exists
from ..schemas import RAW_LAKE, SENTIMENTS
from ..session import discard, stored
from ..sources.lake import LAKE_READ_OPTIONS
from ..streaming.speed import run_available


def merge_partials(spark: SparkSession, table: str, new: DataFrame, batch_id: int,
                   spec: MetricSpec = TWEET_SPEC) -> bool:
    """Fold ``new`` partials into ``table``; returns False for a replayed batch.

    The touched months are replaced together by ``overwrite_safely``: a fold
    that was cut off between two months is finished before anything else, and a
    month that has the batch already is left alone."""
    new = new.withColumn("last_batch", F.lit(batch_id).cast("bigint"))
    if not table_exists(spark, table):
        new.hint("rebalance", "window_month").write.format("parquet").options(**DYNAMIC_OVERWRITE) \
            .partitionBy("window_month").saveAsTable(table)
        return True
    finish_overwrite(spark, table)
    new, folder = stored(new, "partials")
    # calendar months present in the new files: bounded by the time span, not
    # by the rows; as literals they prune the partials scan to those months
    months = [r[0] for r in new.select("window_month").distinct().collect()]
    old = spark.table(table).filter(F.col("window_month").isin(months))
    have = {r[0] for r in old.groupBy("window_month").agg(F.max("last_batch").alias("b")).filter(F.col("b") >= batch_id).collect()}
    todo = [m for m in months if m not in have]
    if todo:
        both = old.drop("last_batch").unionByName(new.drop("last_batch")).filter(F.col("window_month").isin(todo))
        merged = combine_partials(both, spec).withColumn("last_batch", F.lit(batch_id).cast("bigint"))
        overwrite_safely(merged.hint("rebalance", "window_month"), table)
    discard(spark, folder)
    return bool(todo)


DEFAULT_MAX_FILES = 5000


def _new_files(spark: SparkSession, lake_path: str, max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(RAW_LAKE).option("pathGlobFilter", LAKE_READ_OPTIONS["pathGlobFilter"])
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(lake_path).select("*", F.col("_metadata.file_path").alias("_file")))


CHECKPOINT_PROPERTY = "tidemark.partials.checkpoint"


def _bind_checkpoint(spark: SparkSession, table: str, checkpoint: str) -> None:
    """The partials and the stream checkpoint that recorded their files belong
    together: with another checkpoint, batch ids restart and every batch would
    look like a replay. Refuse that instead of silently skipping data."""
    if not table_exists(spark, table):
        return
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    bound = props.get(CHECKPOINT_PROPERTY)
    if bound is None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{CHECKPOINT_PROPERTY}' = '{checkpoint}')")
    elif bound != checkpoint:
        raise ValueError(f"{table} was built with checkpoint {bound}; drop it to rebuild from {checkpoint}")


def update_batch_partials(spark: SparkSession, lake_path: str, table: str, checkpoint: str,
                          time_mode: str = "wall", width: str = "1 hour", spec: MetricSpec = TWEET_SPEC,
                          max_files_per_trigger: int = DEFAULT_MAX_FILES, timeout_s: float | None = None):
    """Fold every lake file not seen before, at any depth of the lake, into the
    partials table, at most ``max_files_per_trigger`` files per micro-batch
    (bounds a bootstrap over a large existing lake as well as the source's
    per-batch bookkeeping).

    A file that can't be read fails the update and stays unseen: it counts once
    it is repaired or moved out of the lake. (Skipping it would record it as
    processed for good.)"""
    raw = _new_files(spark, lake_path, max_files_per_trigger)

    def fold(batch: DataFrame, batch_id: int) -> None:
        merge_partials(spark, table, partial_metrics(batch, parse_time("tweet_created", time_mode), width, spec),
                       batch_id, spec)
        _bind_checkpoint(spark, table, checkpoint)

    _bind_checkpoint(spark, table, checkpoint)
    q = (raw.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return run_available(q, timeout_s)


def batch_metrics_from_partials(spark: SparkSession, table: str, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    return finish_partials(spark.table(table), spec)


# --------------------------------------------------------------------------- lake quality, incrementally
LAKE_STATS_SCHEMA = ("batch_id bigint, files bigint, n bigint, null_tweet_id bigint, null_airline bigint, "
                     "null_airline_sentiment bigint, bad_sent bigint, sent_values array<string>, "
                     "columns array<string>")


def _invalid_table(table: str) -> str:
    return f"{table}_invalid"


def _lake_stats_row(spark: SparkSession, batch: DataFrame, batch_id: int):
    """Additive lake-check ingredients of one micro-batch of files. The file
    list is bounded by ``maxFilesPerTrigger``; only those files' footers are
    read to learn which columns they carry."""
    files = [r[0] for r in batch.select("_file").distinct().collect()]
    if not files:
        return None
    cols = spark.read.option("mergeSchema", "true").parquet(*files).columns
    s = F.col("airline_sentiment")
    r = batch.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in Q.LAKE_NULL_COLUMNS],
                  F.count_if(Q.invalid_sentiment()).alias("bad_sent"),
                  F.array_sort(F.collect_set(F.when(s.isin(*SENTIMENTS), s))).alias("sent_values")).first()
    return (batch_id, len(files), r["n"], r["null_tweet_id"], r["null_airline"], r["null_airline_sentiment"],
            r["bad_sent"], list(r["sent_values"]), cols)


def update_lake_stats(spark: SparkSession, lake_path: str, table: str, checkpoint: str,
                      max_files_per_trigger: int = DEFAULT_MAX_FILES, timeout_s: float | None = None):
    """Add one statistics row per micro-batch of lake files not seen before, at
    any depth, and that batch's invalid values with their counts to a table
    beside it. Idempotent per batch id; bound to its checkpoint like the
    partials. A file that can't be read fails the update and stays unseen."""
    raw = _new_files(spark, lake_path, max_files_per_trigger)
    invalid = _invalid_table(table)

    def fold(batch: DataFrame, batch_id: int) -> None:
        def has(t: str) -> bool:
            return table_exists(spark, t) and not spark.table(t).filter(F.col("batch_id") == batch_id).isEmpty()

        if has(table):
            return
        row = _lake_stats_row(spark, batch, batch_id)
        if row is None:
            return
        if row[6] and not has(invalid):   # before the statistics row, which marks the batch as done
            _add(spark, Q.invalid_values(batch).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "value", "rows"), invalid)
        _add(spark, spark.createDataFrame([row], LAKE_STATS_SCHEMA), table)
        _bind_checkpoint(spark, table, checkpoint)

    _bind_checkpoint(spark, table, checkpoint)
    q = (raw.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return run_available(q, timeout_s)


def _add(spark: SparkSession, rows: DataFrame, table: str) -> None:
    if table_exists(spark, table):
        append_rows(rows, table)
        spark.catalog.refreshTable(table)   # a micro-batch's rows are written in the stream's session
    else:
        rows.write.format("parquet").saveAsTable(table)


def check_lake_from_stats(spark: SparkSession, table: str, layer: str = "lake") -> DataFrame:
    """The lake checks of ``quality.check_lake``, from the statistics tables
    (one small row per processed batch, one per batch and invalid value)
    instead of a scan of the lake."""
    none = Q.no_files(spark, layer)
    if not table_exists(spark, table):
        return none
    t = spark.table(table)
    r = t.agg(F.sum("files").alias("files"), F.sum("n").alias("n"),
              *[F.sum(f"null_{c}").alias(f"null_{c}") for c in Q.LAKE_NULL_COLUMNS], F.sum("bad_sent").alias("bad_sent")).first()
    if not r["files"]:
        return none

    def distinct(c: str) -> list[str]:   # column names, or the known sentiments: few
        return sorted(x[0] for x in t.select(F.explode(c)).distinct().collect())

    cols = distinct("columns")
    nulls = {c: r[f"null_{c}"] for c in Q.LAKE_NULL_COLUMNS}
    bad = r["bad_sent"] if "airline_sentiment" in cols else None
    report = Q.lake_report(spark, layer, r["files"], r["n"], cols, nulls, bad, distinct("sent_values"))
    if not bad:
        return report
    values = spark.table(_invalid_table(table)).groupBy("value").agg(F.sum("rows").alias("rows"))
    return report.unionByName(Q.value_rows(layer, values))
