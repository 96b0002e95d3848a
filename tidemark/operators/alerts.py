"""Alert branch: negative-sentiment filter, keyed upsert, finders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALERT_SENTIMENT, TWEET_FIELDS
from ..session import discard, stored
from .tables import DYNAMIC_OVERWRITE, append_rows, finish_overwrite, overwrite_safely, table_exists

ALERT_COLUMNS = TWEET_FIELDS + ["created_at"]
#: The order key of a table that keeps one: when its row arrived.
ARRIVAL = "arrival"
#: Arrival order of topic records: their time first, as partitions count offsets apart.
RECORD_ORDER = ("timestamp", "partition", "offset")
# Row order inside each bucket file: the finders filter on airline (and time),
# so Parquet min/max statistics let them skip row groups (layout, not indexes).
# The bucket column leads, which is the order the partitioned writer needs anyway.
ALERT_FILE_ORDER = ("bucket", "airline", "created_at")


def alert_filter(df: DataFrame, category: str = "airline_sentiment", value: str = ALERT_SENTIMENT) -> DataFrame:
    """Rows whose category equals ``value`` exactly (case-sensitive); NULL is
    not an alert. Works on batch and streaming input."""
    return df.filter(F.col(category) == F.lit(value))


def latest_per_key(updates: DataFrame, key: str, order_cols) -> DataFrame:
    """One row per key: the one with the greatest ``order_cols`` (last arrival
    wins). ``max_by`` is a partial aggregate, so a key holding a large share
    of the rows is reduced map-side before the shuffle."""
    cols = updates.columns
    row = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_cols])
    return updates.groupBy(F.col(key).alias("_k")).agg(F.max_by(row, order).alias("_r")).select("_r.*")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert(spark: SparkSession, table: str, updates: DataFrame, key: str = "tweet_id",
           order_cols=("_arrival",), buckets: int = 64, stamp: Column | None = None,
           columns=ALERT_COLUMNS, register: bool = False) -> int:
    """Keyed upsert into a managed table partitioned by hash bucket of ``key``.

    * updates are reduced to the last arrival per key (a NULL key is a key);
    * ``created_at`` is stamped (``stamp`` or the current time) unless the
      updates carry it;
    * only the buckets the updates touch are looked at (their ids, at most
      ``buckets`` of them, become a partition filter), and one NULL-safe join
      with their key column marks the updates whose key exists;
    * buckets holding a replaced key are rewritten (old rows minus the
      replaced keys, plus the replacements — whole rows, so a newer NULL
      overwrites an older value): the merged rows are written to a folder of
      their own first, then replace the bucket, and the folder goes when the
      table has them. A crash in between leaves that folder, named in the
      table's properties; the next upsert finishes it first, so no row is lost;
    * new keys — the common case — are appended without rewriting anything;
      ``compact_buckets`` later folds the extra files.

    ``register``: the table keeps each row's order key (column ``arrival``), and an
    update only replaces a row whose order key is smaller. So an older update that
    comes again, in this batch or any later one, from whichever partition, never
    wins; without it a later batch always does. ``order_cols`` must then say when a
    record arrived for good (its time, partition and offset), not where it stands
    in this batch. Rows from before the table had the column give way to any update.

    Idempotent: applying the same updates twice leaves the same table. One
    writer per table (a streaming ``foreachBatch`` applies its batches in
    order). A large bucket is split over several tasks.
    Returns the number of distinct keys written.
    """
    u = updates
    if "created_at" not in u.columns:
        u = u.withColumn("created_at", stamp if stamp is not None else F.current_timestamp())
    if "_arrival" in order_cols and "_arrival" not in u.columns:
        u = u.withColumn("_arrival", F.monotonically_increasing_id())
    if register and "_arrival" in order_cols:
        raise ValueError("a register needs order columns that outlast the batch")
    u = latest_per_key(u, key, order_cols)
    kept = [ARRIVAL] if register else []
    if register:
        u = u.withColumn(ARRIVAL, F.struct(*order_cols))
    u = u.select(*[F.col(c) for c in columns], *kept, bucket_of(F.col(key), buckets).alias("bucket"))
    if not table_exists(spark, table):
        (_dealt(u).write.format("parquet").options(**DYNAMIC_OVERWRITE).partitionBy("bucket").saveAsTable(table))
        return spark.table(table).count()
    finish_overwrite(spark, table)
    if register and ARRIVAL not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ARRIVAL} {u.schema[ARRIVAL].dataType.simpleString()})")
    u, folder = stored(u, "upsert")
    # at most `buckets` small integers: bounded by configuration, not by data;
    # as a literal list they become a static PartitionFilter on the scan
    per_bucket = u.groupBy("bucket").count().collect()      # at most `buckets` rows
    existing = (spark.table(table).filter(F.col("bucket").isin([r[0] for r in per_bucket]))
                .select(F.col(key).alias("_there"), F.lit(True).alias("_old"), *[F.col(c).alias("_then") for c in kept]).distinct())
    met = u.join(existing, F.col(key).eqNullSafe(F.col("_there")), "left")
    if register:
        met = met.filter(F.coalesce(F.col(ARRIVAL) > F.col("_then"), F.lit(True))).drop("_then")
    marked, marks = stored(met.drop("_there"), "upsert")
    replaced = marked.filter("_old").drop("_old")
    rewrite = [r[0] for r in replaced.select("bucket").distinct().collect()]
    if rewrite:
        keys = replaced.select(F.col(key).alias("_there"))
        old = spark.table(table).filter(F.col("bucket").isin(rewrite))
        merged = old.join(keys, F.col(key).eqNullSafe(F.col("_there")), "left_anti").unionByName(replaced)
        overwrite_safely(_dealt(merged), table)
    # new keys are appended after the rewrite (a retry then sees them as
    # existing and rewrites them to the same values: idempotent)
    append_rows(_dealt(marked.filter("_old IS NULL").drop("_old")), table)
    discard(spark, folder, marks)
    return sum(r[1] for r in per_bucket)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a bucket together, in file order; a large bucket over several tasks."""
    return rows.hint("rebalance", "bucket").sortWithinPartitions(*[c for c in ALERT_FILE_ORDER if c in rows.columns])


def compact_buckets(spark: SparkSession, table: str, max_files: int = 8) -> int:
    """Rewrite every bucket that has collected more than ``max_files`` files
    (appends of new keys add files) into few sorted files. The per-bucket file
    counts are one aggregate row per bucket. Returns the buckets rewritten."""
    finish_overwrite(spark, table)
    counts = (spark.table(table).select("bucket", F.col("_metadata.file_path").alias("_f"))
              .groupBy("bucket").agg(F.count_distinct("_f").alias("files")))
    busy = [r[0] for r in counts.filter(F.col("files") > max_files).select("bucket").collect()]
    if busy:
        overwrite_safely(_dealt(spark.table(table).filter(F.col("bucket").isin(busy))), table)
    return len(busy)


def alerts_by_airline(alerts: DataFrame, airline: str) -> DataFrame:
    """Alerts of one airline, newest first."""
    return alerts.filter(F.col("airline") == F.lit(airline)).orderBy(F.desc("created_at"), F.col("tweet_id"))


def alerts_airline_sentiment(alerts: DataFrame, airline: str, sentiment: str) -> DataFrame:
    return alerts.filter((F.col("airline") == F.lit(airline)) & (F.col("airline_sentiment") == F.lit(sentiment)))


def alerts_recent(alerts: DataFrame, airline: str, now: Column | str | None = None, hours: int = 24) -> DataFrame:
    """Alerts of one airline stamped within ``hours`` before ``now``."""
    n = F.current_timestamp() if now is None else (F.lit(now).cast("timestamp") if isinstance(now, str) else now)
    return (alerts.filter((F.col("airline") == F.lit(airline))
                          & (F.col("created_at") >= n - F.make_dt_interval(hours=F.lit(hours))))
                  .orderBy(F.desc("created_at"), F.col("tweet_id")))


def alerts_latest(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest alerts (a top-k: each task keeps its own k, only
    those meet on one task)."""
    return alerts.orderBy(F.desc("created_at"), F.col("tweet_id")).limit(n)
