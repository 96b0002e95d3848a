"""Batch layer kept by file, so that files can leave the lake again.

The batch metrics are a function of what the lake holds now. Beside the merged
partials for each (window, key) this keeps those of every single file and the
list of files that are in (path, size, time of change). An update compares that
list with the lake: only files that are new or were replaced are read, and only
the months that they or the files that left have rows in are written again.
Counts and sums of a file that left are subtracted; a maximum can't be, so that
of a (window, key) the file had rows in is rebuilt from the files that remain.

Tables, below one name: ``<name>`` (merged partials, by month), ``<name>_by_file``
(by month), ``<name>_files`` (by a hash of the path). An update first stores what
each of them will hold in the touched partitions, notes that folder in a table
property, and only then replaces partitions; an update that was cut off is
finished by the next call, so the three tables always go together.

Only committed files count (``sources.lake.committed_files``). A file that can't
be read fails the update, which changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_time
from ..operators.metrics import TWEET_SPEC, MetricSpec, combine_partials, finish_partials, partial_metrics
from ..operators.tables import DYNAMIC_OVERWRITE, drop_partitions, overwrite_partitions, table_exists
from ..schemas import RAW_LAKE
from ..session import discard, folder_exists, scratch_path, stored
from ..sources.lake import lake_files, plain_path

#: Partitions of the list of files; and new files that are read at once at most.
SLOTS, MAX_FILES = 64, 5000
PENDING = "tidemark.retract.pending"
_FILES = "file string, size bigint, changed timestamp, slot int"


@dataclass(frozen=True)
class FilePartials:
    """The three tables and what they are computed with."""
    name: str
    time_mode: str = "wall"
    width: str = "1 hour"
    spec: MetricSpec = TWEET_SPEC

    @property
    def by_file(self) -> str:
        return f"{self.name}_by_file"

    @property
    def files(self) -> str:
        return f"{self.name}_files"

    def sums(self) -> list[str]:
        return [self.spec.count_name, *[self.spec.class_col(c) for c in self.spec.classes], "_sum", "_n"]


def _of_files(spark: SparkSession, files: list[str], p: FilePartials) -> DataFrame:
    """Partials of each of these files."""
    raw = spark.read.schema(RAW_LAKE).parquet(*files).withColumn("file", plain_path(F.col("_metadata.file_path")))
    spec = p.spec
    t = raw.withColumn("_t", parse_time("tweet_created", p.time_mode)).filter(F.col("_t").isNotNull())
    # the file goes through the same aggregate as part of the key
    both = partial_metrics(t.withColumn("_key", F.struct("file", F.col(spec.key).alias("key"))), "_t", p.width, _keyed(spec))
    return both.select(F.col("_key.file").alias("file"), F.col("_key.key").alias(spec.key), *[c for c in both.columns if c != "_key"])


def _keyed(spec: MetricSpec) -> MetricSpec:
    from dataclasses import replace
    return replace(spec, key="_key", key_alias=None)


def _create(spark: SparkSession, p: FilePartials) -> None:
    if table_exists(spark, p.files):
        return
    key = RAW_LAKE[p.spec.key].dataType.simpleString()
    sums = ", ".join(f"{c} bigint" for c in p.sums())
    opts = ", ".join(f"{k} '{v}'" for k, v in DYNAMIC_OVERWRITE.items())
    body = f"{sums}, _max bigint, window_start timestamp_ntz, window_end timestamp_ntz, window_month string"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {p.name} ({p.spec.key} {key}, {body}) USING parquet OPTIONS ({opts}) PARTITIONED BY (window_month)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {p.by_file} (file string, {p.spec.key} {key}, {body}) USING parquet OPTIONS ({opts}) PARTITIONED BY (window_month)")
    spark.sql(f"CREATE TABLE {p.files} ({_FILES}) USING parquet OPTIONS ({opts}) PARTITIONED BY (slot)")


def _months(df: DataFrame) -> list[str]:
    return [r[0] for r in df.select("window_month").distinct().collect()]   # calendar months of the data


def _update_once(spark: SparkSession, path: str, p: FilePartials, max_files: int) -> int:
    """Bring in at most ``max_files`` new files and take out all that left; returns how
    many files changed."""
    same = ["file", "size", "changed"]
    now, scratch = stored(lake_files(spark, path), "lake-files")
    known = spark.table(p.files)
    left, scratch2 = stored(known.join(now, same, "left_anti"), "left-files")
    fresh = [r.asDict() for r in now.join(known, same, "left_anti").orderBy("file").limit(max_files).collect()]
    gone = left.count()
    if not fresh and not gone:
        discard(spark, scratch, scratch2)
        return 0
    by_file, merged = spark.table(p.by_file), spark.table(p.name)
    cols = by_file.columns
    added = _of_files(spark, [r["file"] for r in fresh], p).select(*cols) if fresh else by_file.limit(0)
    added, scratch3 = stored(added, "added-partials")
    took, scratch4 = stored(by_file.join(left.select("file"), "file", "left_semi"), "taken-partials")
    months = sorted(set(_months(added)) | set(_months(took)))
    back = sorted(_months(took))        # months in which rows leave: their files' partials are written anew
    inside = F.col("window_month").isin(months)

    keys = [p.spec.key, "window_start", "window_end", "window_month"]
    minus = took.select(*keys, *[(-F.col(c)).alias(c) for c in p.sums()], F.lit(None).cast("bigint").alias("_max"))
    parts = merged.where(inside).select(*keys, *p.sums(), "_max") \
        .unionByName(added.select(*keys, *p.sums(), "_max")).unionByName(minus)
    sums = combine_partials(parts, p.spec).where(F.col(p.spec.count_name) > 0)
    remain = by_file.where(F.col("window_month").isin(back)).join(left.select("file"), "file", "left_anti").unionByName(added)
    # maxima of the (window, key) groups that lost rows, from the files that remain
    lost = took.select(*[F.col(k).alias(f"_{k}") for k in keys[:2]]).distinct()
    hit = F.col(p.spec.key).eqNullSafe(F.col(f"_{p.spec.key}")) & (F.col("window_start") == F.col("_window_start"))
    rebuilt = remain.join(lost, hit, "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in keys[:2]]).agg(F.max("_max").alias("_rest"), F.lit(True).alias("_hit"))
    fixed = sums.join(rebuilt, hit, "left").withColumn("_max", F.when(F.col("_hit"), F.col("_rest")).otherwise(F.col("_max")))

    slot = F.pmod(F.xxhash64("file"), F.lit(SLOTS)).cast("int")
    listed = known.join(left.select("file"), "file", "left_anti")
    if fresh:
        listed = listed.unionByName(spark.createDataFrame([(r["file"], r["size"], r["changed"]) for r in fresh], "file string, size bigint, changed timestamp")
                                    .withColumn("slot", slot))
    slots = [r[0] for r in left.select("slot").distinct().collect()]     # at most SLOTS
    if fresh:
        slots += [r[0] for r in listed.join(now, "file", "left_semi").select("slot").distinct().collect()]

    folder = scratch_path(spark, "retract")
    fixed.select(*merged.columns).hint("rebalance", "window_month").write.parquet(f"{folder}/merged")
    # without rows that leave, a month's file partials are only added to; a retry replaces the same rows
    rewritten = remain if back else added
    rewritten.where(F.col("window_month").isin(back)).select(*cols).hint("rebalance", "window_month").write.parquet(f"{folder}/by_file")
    added.where(~F.col("window_month").isin(back)).select(*cols).write.parquet(f"{folder}/appended")
    listed.where(F.col("slot").isin(slots)).select("file", "size", "changed", "slot").repartition("slot").write.parquet(f"{folder}/files")
    spark.createDataFrame([(m, m in back) for m in months], "month string, back boolean").coalesce(1).write.parquet(f"{folder}/months")
    spark.createDataFrame([(s,) for s in set(slots)], "slot int").coalesce(1).write.parquet(f"{folder}/slots")
    spark.sql(f"ALTER TABLE {p.files} SET TBLPROPERTIES ('{PENDING}' = '{folder}')")
    finish(spark, p)
    discard(spark, scratch, scratch2, scratch3, scratch4)
    return len(fresh) + gone


def _replace(spark: SparkSession, table: str, column: str, values: list, rows: DataFrame) -> None:
    """The partitions of ``values`` hold these rows from here on, or are gone."""
    there = {r[0] for r in rows.select(column).distinct().collect()}     # partitions of one update
    overwrite_partitions(rows, table)
    drop_partitions(spark, table, [{column: v} for v in values if v not in there])


def finish(spark: SparkSession, p: FilePartials) -> bool:
    """Complete an update whose contents were stored and noted; returns whether there
    was one. Each step replaces partitions by stored rows, so it may run twice."""
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {p.files}").collect()}
    folder = props.get(PENDING)
    if not folder:
        return False
    months = spark.read.parquet(f"{folder}/months").collect()
    all_months, back = [r["month"] for r in months], [r["month"] for r in months if r["back"]]
    _replace(spark, p.name, "window_month", all_months, spark.read.schema(spark.table(p.name).schema).parquet(f"{folder}/merged"))
    schema = spark.table(p.by_file).schema
    if back:
        _replace(spark, p.by_file, "window_month", back, spark.read.schema(schema).parquet(f"{folder}/by_file"))
    if folder_exists(spark, f"{folder}/appended"):
        _append_once(spark, p, spark.read.schema(schema).parquet(f"{folder}/appended"))
    slots = [r[0] for r in spark.read.parquet(f"{folder}/slots").collect()]
    _replace(spark, p.files, "slot", slots, spark.read.schema(_FILES).parquet(f"{folder}/files"))
    spark.sql(f"ALTER TABLE {p.files} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    for t in (p.name, p.by_file, p.files):
        spark.catalog.refreshTable(t)
    discard(spark, folder)
    return True


def _append_once(spark: SparkSession, p: FilePartials, rows: DataFrame) -> None:
    """Append file partials, but for those that a run that was cut off has appended."""
    months = _months(rows)
    if not months:
        return
    there = spark.table(p.by_file).where(F.col("window_month").isin(months)).select("file", "window_month", "window_start", F.col(p.spec.key).alias("_key"))
    same = (F.col("a.file") == F.col("b.file")) & (F.col("a.window_month") == F.col("b.window_month")) \
        & (F.col("a.window_start") == F.col("b.window_start")) & F.col(f"a.{p.spec.key}").eqNullSafe(F.col("b._key"))
    todo, folder = stored(rows.alias("a").join(there.alias("b"), same, "left_anti"), "append")
    todo.select(*spark.table(p.by_file).columns).write.mode("append").insertInto(p.by_file)
    spark.catalog.refreshTable(p.by_file)
    discard(spark, folder)


def update_by_file(spark: SparkSession, lake_path: str, p: FilePartials, max_files: int = MAX_FILES) -> int:
    """Bring the tables up to what the lake holds now; returns how many files came,
    left or were replaced (a replaced one counts twice)."""
    _create(spark, p)
    finish(spark, p)
    total = 0
    while n := _update_once(spark, lake_path, p, max_files):
        total += n
    return total


def metrics_by_file(spark: SparkSession, p: FilePartials) -> DataFrame:
    """The batch metrics of the files that are in."""
    return finish_partials(spark.table(p.name), p.spec)
