"""Serving layer: publish, unified view, pruning, range scans, archive."""

from __future__ import annotations

import logging
import re
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ltz_lit, ntz_lit, time_text
from ..schemas import METRIC_FIELDS, METRICS_TABLE, SOURCE_BATCH, SOURCE_SPEED
from ..session import adaptive, discard, file_system, folder_exists, stored
from ..sources.ledger import Ledger
from .metrics import from_two_clocks, two_clock_partials, with_month
from .tables import (DYNAMIC_OVERWRITE, append_rows, drop_partitions, finish_overwrite, overwrite_safely,
                     partition_values, table_exists, table_location)

log = logging.getLogger(__name__)
EPOCH = "1970-01-01 00:00:00"
#: Table property: the latest window end of a published version.
LAST_END = "tidemark.window_end.max"


# --------------------------------------------------------------------------- unified view
def unified(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """Batch rows (all of them) ∪ speed rows that start at or after the end of
    the last batch window; each tagged with its source.

    The cut-off is a scalar subquery (one row, run once, reused); with an
    empty batch side it falls back to the epoch, i.e. all speed rows pass.
    """
    cut = F.coalesce(batch.select(F.max("window_end")).scalar(),
                     F.lit(EPOCH).cast("timestamp_ntz"))
    b = batch.select(*METRIC_FIELDS, F.lit(SOURCE_BATCH).alias("source"))
    tail = speed.filter(F.col("window_start") >= cut)
    if "window_date" in speed.columns:
        # implied by the line above (window_end >= window_start >= cut); it
        # lets a date-partitioned speed table skip older partitions at run time
        # (a NULL window_end lands in the NULL date partition: keep that one)
        tail = tail.filter((F.col("window_date") >= F.date_format(cut, "yyyy-MM-dd"))
                           | F.col("window_date").isNull())
    s = tail.select(*METRIC_FIELDS, F.lit(SOURCE_SPEED).alias("source"))
    return b.unionByName(s)


def unified_in_one_pass(tweets: DataFrame, time_mode: str = "wall") -> DataFrame:
    """``unified`` of the batch and speed metrics of the same rows, which are read
    once: hours, minutes and the cut-off all come from one stored table of minute
    partials with both clocks."""
    partials, _ = stored(two_clock_partials(tweets), "two-clocks")
    return unified(from_two_clocks(partials, "1 hour", "batch", time_mode), from_two_clocks(partials, "1 minute", "speed", "instant"))


def create_unified_view(spark: SparkSession, name: str, batch_table: str, speed_table: str,
                        pin: bool = False) -> None:
    """Catalog view of ``unified`` over two tables (SQL text, so readers of the
    view always see the tables' current state).

    ``pin``: the view names the published version of ``batch_table`` and its
    known end, so reading it never scans the batch table for the cut-off, and
    batch rows and cut-off belong together. Create it again after each publish,
    as the batch cycle does (the version before stays until the publish after)."""
    cols = ", ".join(METRIC_FIELDS)
    version = current_version(spark, batch_table) if pin else None
    if version is not None:
        cut = f"CAST('{published_end(spark, batch_table) or EPOCH}' AS TIMESTAMP_NTZ)"
        batch_table = f"{batch_table}_v{version}"
    else:
        cut = f"coalesce((SELECT max(window_end) FROM {batch_table}), CAST('{EPOCH}' AS TIMESTAMP_NTZ))"
    date_cut = ""
    if "window_date" in spark.table(speed_table).columns:
        date_cut = f"\n          AND (window_date IS NULL OR window_date >= date_format({cut}, 'yyyy-MM-dd'))"
    spark.sql(f"""CREATE OR REPLACE VIEW {name} AS
        SELECT {cols}, '{SOURCE_BATCH}' AS source FROM {batch_table}
        UNION ALL
        SELECT {cols}, '{SOURCE_SPEED}' AS source FROM {speed_table}
        WHERE window_start >= {cut}{date_cut}""")


# --------------------------------------------------------------------------- publish
def publish_version(df: DataFrame, name: str, version: int | None = None, keep: int = 1,
                    partition_by: str = "window_month") -> int:
    """Write ``df`` as table ``<name>_v<version>`` (partitioned by month), then
    point view ``<name>`` at it in one catalog statement.

    Until the flip, readers see the previous version; if writing fails the
    view is untouched and the half-written table is dropped. A version number
    must be above every one before it. After the flip the newest ``keep`` older
    versions are kept (running readers may still be scanning them); the one the
    view names is never dropped.

    Rows are dealt out by month with ``REBALANCE``: one writer per small month,
    several for a large one. The latest window end is kept as a property of the
    table, so the unified view and pruning need not scan for it. Returns the
    version."""
    spark = df.sparkSession
    there = versions(spark, name)
    version = version if version is not None else max(int(time.time() * 1000), there[-1] + 1 if there else 0)
    if there and version <= there[-1]:
        raise ValueError(f"version {version} of {name} is not above version {there[-1]}")
    target = f"{name}_v{version}"
    data = with_month(df) if partition_by == "window_month" and "window_month" not in df.columns else df
    try:
        (data.hint("rebalance", partition_by).write.format("parquet").partitionBy(partition_by)
             .saveAsTable(target))
        if "window_end" in data.columns:
            last = spark.table(target).agg(F.max("window_end").cast("string")).first()[0]
            spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{LAST_END}' = '{last or EPOCH}')")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {target}")
    for old in versions(spark, name)[:-(keep + 1)]:
        if old != version:
            spark.sql(f"DROP TABLE IF EXISTS {name}_v{old}")
    return version


def published_end(spark: SparkSession, name: str) -> str | None:
    """The latest window end of the published version, as text, without a scan;
    None if nothing is published or it holds no window."""
    version = current_version(spark, name)
    if version is None:
        return None
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}_v{version}").collect()}
    return None if props.get(LAST_END, EPOCH) == EPOCH else props[LAST_END]


def versions(spark: SparkSession, name: str) -> list[int]:
    db, _, base = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES IN {db}" if db else "SHOW TABLES").collect()
    out = []
    for r in rows:
        t = r["tableName"]
        if t.startswith(f"{base}_v") and t[len(base) + 2:].isdigit():
            out.append(int(t[len(base) + 2:]))
    return sorted(out)


def current_version(spark: SparkSession, name: str) -> int | None:
    if not table_exists(spark, name):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {name}").collect()[0][0]
    found = re.findall(rf"{re.escape(name.rpartition('.')[2])}_v(\d+)", text)
    return int(found[-1]) if found else None


# --------------------------------------------------------------------------- speed table
def with_window_date(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("window_date", F.date_format("window_end", "yyyy-MM-dd"))


def create_speed_table(spark: SparkSession, table: str) -> None:
    """Speed-layer metrics table: the 12 metric columns + created_at, the writer
    and its micro-batch id, partitioned by the date of window_end."""
    if table_exists(spark, table):
        return
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in METRICS_TABLE.fields)
    opts = ", ".join(f"{k} '{v}'" for k, v in DYNAMIC_OVERWRITE.items())
    spark.sql(f"""CREATE TABLE {table} ({cols}, created_at timestamp, writer string, batch_id bigint, window_date string)
                  USING parquet OPTIONS ({opts}) PARTITIONED BY (window_date)""")


#: Shuffle partitions of an append to the speed table, at least; small ones are joined
#: again. A stream's session has as many as its state, each of which would hold so many dates.
APPEND_PARTITIONS = 200

#: The writer's name in the ledger where none is given.
UNNAMED = "unnamed"


def speed_ledger(spark: SparkSession, table: str) -> Ledger:
    """The commit ledger of a speed table, a hidden folder beside its partitions."""
    return Ledger(spark, f"{table_location(spark, table)}/_ledger")


def committed_speed(spark: SparkSession, table: str) -> DataFrame:
    """The speed table without rows of a micro-batch that is being written, or
    whose writing was cut off and not yet tried again."""
    df = spark.table(table)
    for writer, batch in speed_ledger(spark, table).unfinished():
        df = df.filter(~_of_batch("" if writer == UNNAMED else writer, batch))
    return df


def _of_batch(writer: str, batch_id: int):
    return F.col("writer").eqNullSafe(F.lit(writer)) & F.col("batch_id").eqNullSafe(F.lit(batch_id))


def _remove_batch(spark: SparkSession, table: str, writer: str, batch_id: int) -> int:
    """Take out what a cut-off append has left; returns how many dates it touched."""
    finish_overwrite(spark, table)
    t, own = spark.table(table), _of_batch(writer, batch_id)
    dates = [r[0] for r in t.filter(own).select("window_date").distinct().collect()]   # dates of one micro-batch
    for date in dates:
        rest = t.filter(F.col("window_date").eqNullSafe(F.lit(date)) & ~own)
        if rest.isEmpty():
            drop_partitions(spark, table, [{"window_date": date}])
        else:
            overwrite_safely(rest, table)
    spark.catalog.refreshTable(table)
    return len(dates)


def append_speed(metrics: DataFrame, table: str, batch_id: int, now=None, writer: str = "") -> bool:
    """Append one micro-batch of speed metrics, stamped with ``created_at``.

    Idempotent per (``writer``, ``batch_id``), by the table's commit ledger: the
    batch is entered as begun before its first row and as done after its last one.
    A retry of a done batch is a replay and is skipped, without a look at the
    table; a retry of a begun one first takes out the rows that are there, so a
    commit that died halfway neither loses nor doubles a row. ``writer`` is the
    streaming query's id, which a new checkpoint changes: its batches start at 0
    again and are another writer's, not replays. Rows that an earlier release
    wrote without a ledger are recognised. Returns whether rows were written."""
    spark = metrics.sparkSession
    book, name = speed_ledger(spark, table), writer or UNNAMED
    state = book.state(name, batch_id)
    if state == "done":
        return False
    if state == "begun":
        _remove_batch(spark, table, writer, batch_id)
    elif not book.knows(name) and not spark.table(table).filter(_of_batch(writer, batch_id)).isEmpty():
        return False
    book.begin(name, batch_id)
    t = F.current_timestamp() if now is None else ltz_lit(now)
    rows = with_window_date(metrics.select(*METRIC_FIELDS)).select(
        *METRIC_FIELDS, t.alias("created_at"), F.lit(writer).alias("writer"),
        F.lit(batch_id).cast("bigint").alias("batch_id"), "window_date")
    # few files per date, not one for each state partition, but a large date (a replay) is split over several tasks
    counted = Observation()
    dealt = max(APPEND_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with adaptive(spark):
        append_rows(rows.hint("rebalance", dealt, "window_date").observe(counted, F.count(F.lit(1)).alias("n")), table)
    book.done(name, batch_id, counted.get.get("n", 0))
    return True


def prune_speed(spark: SparkSession, table: str, cutoff) -> int:
    """Remove speed rows with ``window_end <= cutoff``; rows with a NULL
    window_end stay; no cutoff → no-op. Returns the number of rows removed.

    Date partitions before the cutoff's date hold only prunable rows and are
    dropped as a whole (catalog operation, no data read); only the cutoff's
    own date is rewritten. Every step leaves the table consistent: the edge
    is replaced first (``overwrite_safely``: a cut-off replacement is finished
    by the next call), the old partitions are dropped after, so a failure in
    between only leaves rows a re-run removes."""
    if cutoff is None:
        return 0
    finish_overwrite(spark, table)
    cut = ntz_lit(cutoff)
    cut_date = time_text(cutoff)[:10]
    t = spark.table(table)
    removed = (t.filter(F.col("window_date") <= F.lit(cut_date))
                .filter(F.col("window_end") <= cut).count())
    if removed == 0:
        return 0
    edge = t.filter(F.col("window_date") == F.lit(cut_date))
    kept_edge = edge.filter(~F.coalesce(F.col("window_end") <= cut, F.lit(False)))
    if kept_edge.isEmpty():
        drop_partitions(spark, table, [{"window_date": cut_date}])
    else:
        overwrite_safely(kept_edge, table)
    before = [s["window_date"] for s in partition_values(spark, table)
              if s["window_date"] != "__HIVE_DEFAULT_PARTITION__" and s["window_date"] < cut_date]
    drop_partitions(spark, table, [{"window_date": d} for d in before])
    spark.catalog.refreshTable(table)
    return removed


# --------------------------------------------------------------------------- scans, archive
def time_range(df: DataFrame, start, end, month_col: str = "window_month") -> DataFrame:
    """``window_start BETWEEN start AND end`` plus the derived month predicate,
    so that a month-partitioned table only lists the months in range."""
    s, e = ntz_lit(start), ntz_lit(end)
    out = df.filter(F.col("window_start").between(s, e))
    if month_col in df.columns:
        out = out.filter(F.col(month_col).between(F.date_format(s, "yyyy-MM"), F.date_format(e, "yyyy-MM")))
    return out


def metrics_for_airline(df: DataFrame, airline: str) -> DataFrame:
    return df.filter(F.col("airline") == F.lit(airline))


#: A version of the archive is complete once its writer has left this file, its last.
COMPLETE = "_SUCCESS"


def archive_versions(spark: SparkSession, path: str, complete: bool = True) -> list[str]:
    """The folders of the archive's versions, oldest first."""
    fs, root = file_system(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    found = [f"{path.rstrip('/')}/{n}" for n in sorted(names) if re.fullmatch(r"version-\d{15}", n)]
    return [v for v in found if not complete or folder_exists(spark, f"{v}/{COMPLETE}")]


def archive(df: DataFrame, path: str, keep: int = 1) -> str:
    """Write the archive anew, one folder per airline, as a version of its own below
    ``path``; returns that folder. Until it is complete, ``read_archive`` gives the
    version before, so an archive exists at all times; after that, all but the
    newest ``keep`` versions before it are removed, and what cut-off writers left.

    Read it with partition type inference off (the session default here), or an
    airline such as ``007`` turns into the number 7. Few files per airline: a small
    one has one writer, a large one several."""
    spark = df.sparkSession
    before = archive_versions(spark, path)
    newest = int(before[-1][-15:]) if before else 0
    folder = f"{path.rstrip('/')}/version-{max(int(time.time() * 1000), newest + 1):015d}"
    df.hint("rebalance", "airline").write.partitionBy("airline").parquet(folder)
    kept = {*(before[-keep:] if keep else []), folder}
    discard(spark, *[v for v in archive_versions(spark, path, complete=False) if v not in kept])
    return folder


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version (or the folder itself, as earlier releases wrote it)."""
    there = archive_versions(spark, path)
    return spark.read.parquet(there[-1] if there else path).select(*METRIC_FIELDS)


def max_window_end(df: DataFrame):
    return df.agg(F.max("window_end")).first()[0]


def safe_prune(spark: SparkSession, table: str, cutoff) -> int | None:
    """Prune, but only log a failure (the cycle goes on)."""
    try:
        return prune_speed(spark, table, cutoff)
    except Exception as e:  # noqa: BLE001 - logged by design
        log.error("speed layer pruning failed: %s", e)
        return None
