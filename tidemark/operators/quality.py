"""Data-quality checks over every layer, as one aggregate pass per table.

Each check yields a ``DQ_REPORT`` row (layer, check, passed, detail). Checks
are computed with ``count_if`` aggregates in a single job per table; only
that one result row reaches the driver. A failing value check adds one report
row per invalid value, which stay a distributed DataFrame however many there
are. A read or query failure, or an absent table, becomes a FAIL row and the
other layers still report.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALERT_SENTIMENT, DQ_REPORT, RAW_LAKE_FIELDS, SENTIMENTS
from ..session import discard, stored
from ..sources.lake import committed_files, lake_files
from .footers import footer_index, layouts, opened_by_tasks

log = logging.getLogger(__name__)

# ---- fixed values: checked columns ------------------------------------------
LAKE_NULL_COLUMNS = ["tweet_id", "airline", "airline_sentiment"]
METRIC_NULL_COLUMNS = ["airline", "tweet_count"]
METRIC_RATIO_COLUMNS = ["positive_ratio", "negative_ratio"]
METRIC_NONNEG_COLUMNS = ["tweet_count", "positive_count", "negative_count"]
ALERT_REQUIRED_COLUMNS = ["tweet_id", "airline"]
# ----------------------------------------------------------------------------
VALUE_CHECK = "sentiment values valid"
#: The rows that name each invalid value: details of the check above, not checks.
VALUE_DETAIL = "invalid sentiment value"
LAYERS = {"lake": "lake", "speed": "speed", "batch": "batch", "alerts": "alerts"}


class QualityError(RuntimeError):
    """Raised by ``summary(..., raise_on_fail=True)`` when any check failed."""


def _report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DQ_REPORT)


def _row(layer, check, passed, detail):
    return (layer, check, bool(passed), detail)


def _message(e: Exception) -> str:
    return str(e).split("\n")[0]


def invalid_sentiment():
    s = F.col("airline_sentiment")
    return s.isNotNull() & ~s.isin(*SENTIMENTS)


def invalid_values(df: DataFrame) -> DataFrame:
    """(value, rows) of every sentiment that is none of the known ones."""
    return df.filter(invalid_sentiment()).groupBy(F.col("airline_sentiment").alias("value")).agg(F.count("*").alias("rows"))


def value_rows(layer: str, values: DataFrame) -> DataFrame:
    """A failed report row for each invalid (value, rows)."""
    detail = F.concat(F.col("value"), F.lit(": "), F.col("rows").cast("string"), F.lit(" rows"))
    return values.select(F.lit(layer).alias("layer"), F.lit(VALUE_DETAIL).alias("check"), F.lit(False).alias("passed"),
                         detail.alias("detail"))


def check_lake(spark: SparkSession, path: str, layer: str = "lake") -> DataFrame:
    """Lake checks: files exist (else stop), rows > 0, expected columns
    present (extra allowed), no NULL ids / airlines / sentiments, sentiment
    values valid (NULLs ignored; every invalid value is reported).

    Files, rows and columns come from an index of all footers (``footers``), read in
    tasks: the columns are those of all files together, and a row of a file that
    lacks one of them has NULL there. NULLs and values are one aggregate over three
    columns. Files of micro-batches that are not committed are left out."""
    try:
        files, n, cols = _lake_contents(spark, path)
        if files == 0:
            return no_files(spark, layer)
        checked = [c for c in LAKE_NULL_COLUMNS if c in cols]
        df = spark.read.schema(", ".join(f"{c} string" for c in LAKE_NULL_COLUMNS)).option("pathGlobFilter", "*.parquet") \
            .option("recursiveFileLookup", "true").parquet(path).where(committed_files(spark, path))
        aggs = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked]
        has_sent = "airline_sentiment" in cols
        if has_sent:
            s = F.col("airline_sentiment")
            aggs.append(F.count_if(invalid_sentiment()).alias("bad_sent"))
            aggs.append(F.array_sort(F.collect_set(F.when(s.isin(*SENTIMENTS), s))).alias("sent_values"))
        r = df.agg(*aggs).first() if aggs else {}
    except Exception as e:  # noqa: BLE001 - reported, not raised
        msg = _message(e)
        if "PATH_NOT_FOUND" in msg or "UNABLE_TO_INFER_SCHEMA" in msg:
            return no_files(spark, layer)
        return _report(spark, [_row(layer, "lake read", False, msg)])
    nulls = {c: r[f"null_{c}"] for c in checked}
    bad = r["bad_sent"] if has_sent else None
    report = _report(spark, lake_report_rows(layer, files, n, cols, nulls, bad, r["sent_values"] if has_sent else []))
    return report.unionByName(value_rows(layer, invalid_values(df))) if bad else report


def _lake_contents(spark: SparkSession, path: str) -> tuple[int, int, list[str]]:
    """Files, rows and the columns of all files, from the footers. Where tasks can't
    open the store's files by themselves, Spark merges the footers' columns."""
    found = lake_files(spark, path)
    if not opened_by_tasks(path):
        files = found.count()
        df = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path)
        return files, df.where(committed_files(spark, path)).count() if files else 0, df.columns if files else []
    index, folder = stored(footer_index(spark, path, found), "footers")
    files, n, broken, first = index.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0)), F.count("error"),
                                        F.min(F.when(F.col("error").isNotNull(), F.concat("file", F.lit(": "), "error")))).first()
    if broken:
        raise ValueError(f"{broken} files can't be read, {first}")
    cols = [r[0] for r in index.select(F.explode("columns")).distinct().collect()]      # column names
    discard(spark, folder)
    return files, n, cols


def layout_rows(spark: SparkSession, path: str, layer: str = "lake") -> DataFrame:
    """A report row for each set of columns that files of the lake have."""
    found = layouts(footer_index(spark, path))
    detail = F.concat(F.col("files").cast("string"), F.lit(" files, "), F.col("rows").cast("string"), F.lit(" rows: "), F.array_join("columns", ", "))
    return found.select(F.lit(layer).alias("layer"), F.lit("layout").alias("check"), F.lit(True).alias("passed"), detail.alias("detail"))


def lake_report_rows(layer: str, files: int, n: int, cols, nulls: dict, bad: int | None, values: list) -> list[tuple]:
    """Report rows of the lake checks from their additive ingredients (shared
    by the full scan and the incremental statistics). ``bad`` is None when
    the sentiment column is absent."""
    rows = [_row(layer, "files exist", True, f"{files} files found"),
            _row(layer, "row count > 0", n > 0, f"{n} rows")]
    missing = sorted(set(RAW_LAKE_FIELDS) - set(cols))
    rows.append(_row(layer, "schema (7 columns)", not missing,
                     f"missing columns: {', '.join(missing)}" if missing else f"columns: {', '.join(sorted(cols))}"))
    for c in LAKE_NULL_COLUMNS:
        if c in cols:
            rows.append(_row(layer, f"null check: {c}", nulls[c] == 0, f"{nulls[c]} nulls"))
    if bad is not None:
        detail = f"{bad} rows with invalid values" if bad else f"values: {', '.join(sorted(values))}"
        rows.append(_row(layer, VALUE_CHECK, bad == 0, detail))
    return rows


def lake_report(spark: SparkSession, *ingredients) -> DataFrame:
    return _report(spark, lake_report_rows(*ingredients))


def no_files(spark: SparkSession, layer: str) -> DataFrame:
    return _report(spark, [_row(layer, "files exist", False, "no parquet files found")])


def check_metrics(df: DataFrame, layer: str) -> DataFrame:
    """Metric-table checks: rows > 0 (else stop), no NULL airline or count,
    ratios within [0, 1] (NaN counts as out of range, NULL does not), counts
    not negative, class counts not above the total."""
    spark = df.sparkSession
    try:
        aggs = [F.count(F.lit(1)).alias("n")]
        aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in METRIC_NULL_COLUMNS]
        aggs += [F.count_if((F.col(c) < 0) | (F.col(c) > 1)).alias(f"range_{c}") for c in METRIC_RATIO_COLUMNS]
        aggs += [F.count_if(F.col(c) < 0).alias(f"neg_{c}") for c in METRIC_NONNEG_COLUMNS]
        aggs.append(F.count_if(F.col("positive_count") + F.col("negative_count") + F.col("neutral_count")
                               > F.col("tweet_count")).alias("inconsistent"))
        r = df.agg(*aggs).first()
    except Exception as e:  # noqa: BLE001
        return _report(spark, [_row(layer, "query execution", False, _message(e))])
    rows = [_row(layer, "row count > 0", r["n"] > 0, f"{r['n']} rows")]
    if r["n"] == 0:
        return _report(spark, rows)
    for c in METRIC_NULL_COLUMNS:
        n = r[f"null_{c}"]
        rows.append(_row(layer, f"null check: {c}", n == 0, f"{n} nulls"))
    for c in METRIC_RATIO_COLUMNS:
        n = r[f"range_{c}"]
        rows.append(_row(layer, f"ratio range 0-1: {c}", n == 0, f"{n} out of range"))
    for c in METRIC_NONNEG_COLUMNS:
        n = r[f"neg_{c}"]
        rows.append(_row(layer, f"non-negative: {c}", n == 0, f"{n} negative"))
    n = r["inconsistent"]
    rows.append(_row(layer, "class counts <= tweet_count", n == 0, f"{n} inconsistent"))
    return _report(spark, rows)


def check_alerts(df: DataFrame, layer: str = "alerts") -> DataFrame:
    """Alert checks: rows > 0 (else stop), ids and airlines neither NULL,
    missing nor empty, every alert negative (NULL sentiment fails)."""
    spark = df.sparkSession
    try:
        aggs = [F.count(F.lit(1)).alias("n")]
        for c in ALERT_REQUIRED_COLUMNS:
            if c in df.columns:
                aggs.append(F.count_if(F.col(c).isNull() | (F.col(c) == F.lit(""))).alias(f"null_{c}"))
            else:
                aggs.append(F.count(F.lit(1)).alias(f"null_{c}"))
        s = F.col("airline_sentiment") if "airline_sentiment" in df.columns else F.lit(None).cast("string")
        aggs.append(F.count_if(~s.eqNullSafe(F.lit(ALERT_SENTIMENT))).alias("not_negative"))
        r = df.agg(*aggs).first()
    except Exception as e:  # noqa: BLE001
        return _report(spark, [_row(layer, "query execution", False, _message(e))])
    rows = [_row(layer, "row count > 0", r["n"] > 0, f"{r['n']} rows")]
    if r["n"] == 0:
        return _report(spark, rows)
    for c in ALERT_REQUIRED_COLUMNS:
        n = r[f"null_{c}"]
        rows.append(_row(layer, f"null check: {c}", n == 0, f"{n} nulls"))
    n = r["not_negative"]
    rows.append(_row(layer, "all negative", n == 0, f"{n} not negative"))
    return _report(spark, rows)


def check_table(spark: SparkSession, table: str, layer: str, checker) -> DataFrame:
    """Run a checker on a catalog table; a missing table has no rows: a FAIL row."""
    try:
        if not spark.catalog.tableExists(table):
            return _report(spark, [_row(layer, "row count > 0", False, "no table")])
        df = spark.table(table)
    except Exception as e:  # noqa: BLE001
        return _report(spark, [_row(layer, "connection", False, _message(e))])
    return checker(df, layer)


def failed_layer(spark: SparkSession, layer: str, e: Exception) -> DataFrame:
    """The report of a layer whose check could not be made."""
    return _report(spark, [_row(layer, "query execution", False, _message(e))])


def run_checks(spark: SparkSession, lake_path: str | None = None, speed: DataFrame | None = None,
               batch: DataFrame | None = None, alerts: DataFrame | None = None,
               lake_report: DataFrame | None = None, alerts_report: DataFrame | None = None) -> DataFrame:
    parts = []
    if lake_report is not None:
        parts.append(lake_report)
    elif lake_path is not None:
        parts.append(check_lake(spark, lake_path))
    if speed is not None:
        parts.append(check_metrics(speed, "speed"))
    if batch is not None:
        parts.append(check_metrics(batch, "batch"))
    if alerts_report is not None:
        parts.append(alerts_report)
    elif alerts is not None:
        parts.append(check_alerts(alerts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(report: DataFrame, started: float | None = None, raise_on_fail: bool = False) -> DataFrame:
    """One row: total, passed, failed checks (rows that name a single invalid value
    are details of a check). Logs the duration when ``started`` is given; raises
    ``QualityError`` on any failure when asked to."""
    s = report.filter(F.col("check") != VALUE_DETAIL).agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"),
                   F.count_if(~F.col("passed")).alias("failed"))
    if started is not None or raise_on_fail:
        r = s.first()
        if started is not None:
            log.info("quality: %s checks, %s passed, %s failed in %.1fs", r["total"], r["passed"], r["failed"],
                     time.time() - started)
        if raise_on_fail and r["failed"]:
            raise QualityError(f"{r['failed']} of {r['total']} quality checks failed")
    return s
