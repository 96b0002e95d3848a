import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import serving as S
from tidemark.schemas import METRIC_FIELDS, METRICS_TABLE


def T(h, m=0):
    return dt.datetime(2024, 1, 2, h, m)


def metric(airline, start, end):
    return (airline, 1, 1, 0, 0, 1.0, 0.0, 1.0, 1, 1 / 60, start, end)


@pytest.fixture
def db(spark, tmp):
    name = "srv_" + os.path.basename(tmp).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{os.path.join(tmp, 'db')}'")
    return name


def test_unified_cutoff_edges(spark):
    batch = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    speed = spark.createDataFrame([metric("a", T(10, 59), T(11)),     # before the cut-off: dropped
                                   metric("a", T(11), T(11, 1)),      # at max(window_end): kept
                                   metric("a", T(11, 5), T(11, 6))], METRICS_TABLE)
    u = S.unified(batch, speed)
    assert u.columns == METRIC_FIELDS + ["source"]
    got = sorted((r.source, r.window_start) for r in u.collect())
    assert got == [("BATCH", T(10)), ("REAL-TIME", T(11)), ("REAL-TIME", T(11, 5))]
    empty = spark.createDataFrame([], METRICS_TABLE)
    assert S.unified(empty, speed).count() == 3          # epoch default: every speed row


def test_prune_edges_and_idempotence(spark, db):
    table = f"{db}.speed"
    S.create_speed_table(spark, table)
    rows = [metric("a", T(9), T(10)), metric("a", T(10), T(11)),     # equal to cut-off: removed
            metric("a", T(11), T(12)), metric("a", None, None),       # later / NULL: kept
            ("b", 1, 1, 0, 0, 1.0, 0.0, 1.0, 1, 1 / 60, dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6))]
    S.append_speed(spark.createDataFrame(rows, METRICS_TABLE), table, 0)
    assert S.append_speed(spark.createDataFrame(rows, METRICS_TABLE), table, 0) is False   # replay skipped
    assert S.prune_speed(spark, table, None) == 0
    assert S.prune_speed(spark, table, T(11)) == 3
    left = sorted((r.window_end or dt.datetime.min) for r in spark.table(table).collect())
    assert left == [dt.datetime.min, T(12)]
    assert S.prune_speed(spark, table, T(11)) == 0        # twice equals once
    assert [s["window_date"] for s in S.partition_values(spark, table)
            if s["window_date"] == "2024-01-01"] == []   # whole old partition dropped


def test_publish_flip_and_failure_keeps_old(spark, db):
    name = f"{db}.batch"
    v1 = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    S.publish_version(v1, name, version=1)
    assert spark.table(name).count() == 1
    bad = v1.withColumn("tweet_count", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception):
        S.publish_version(bad, name, version=2)
    assert spark.table(name).count() == 1 and S.versions(spark, name) == [1]
    v3 = v1.unionByName(spark.createDataFrame([metric("b", T(11), T(12))], METRICS_TABLE))
    S.publish_version(v3, name, version=3)
    S.publish_version(v3, name, version=4)
    assert spark.table(name).count() == 2
    assert S.versions(spark, name) == [3, 4]             # keep one older version
    assert S.current_version(spark, name) == 4
    with pytest.raises(ValueError):                       # an existing version is never replaced
        S.publish_version(v1, name, version=4)
    assert spark.table(name).count() == 2
    assert "window_month" in spark.table(name).columns


def test_time_range_prunes_months(spark, db):
    name = f"{db}.batch"
    rows = [metric("a", dt.datetime(2024, m, 15), dt.datetime(2024, m, 15, 1)) for m in (1, 2, 3)]
    S.publish_version(spark.createDataFrame(rows, METRICS_TABLE), name, version=1)
    r = S.time_range(spark.table(name), "2024-02-01 00:00:00", "2024-02-28 00:00:00")
    assert r.count() == 1
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "window_month" in plan.split("PartitionFilters")[1][:200]


def test_archive_keeps_text_airline(spark, tmp):
    df = spark.createDataFrame([metric("007", T(10), T(11))], METRICS_TABLE)
    S.archive(df, os.path.join(tmp, "arch"))
    r = S.read_archive(spark, os.path.join(tmp, "arch")).first()
    assert r.airline == "007"


def test_sql_view_equals_unified(spark, db):
    batch = spark.createDataFrame([metric("a", T(10), T(11)), metric("b", T(9), T(10))], METRICS_TABLE)
    speed = spark.createDataFrame([metric("a", T(10, 59), T(11)), metric("a", T(11), T(11, 1)),
                                   metric("c", T(12), T(12, 1))], METRICS_TABLE)
    batch.write.saveAsTable(f"{db}.b")
    speed.write.saveAsTable(f"{db}.s")
    S.create_unified_view(spark, f"{db}.u", f"{db}.b", f"{db}.s")
    key = lambda r: (r.source, r.airline, r.window_start)
    assert sorted(spark.table(f"{db}.u").collect(), key=key) == sorted(S.unified(batch, speed).collect(), key=key)
    spark.sql(f"INSERT INTO {db}.b SELECT * FROM {db}.s WHERE airline = 'c'")   # view follows the tables
    assert spark.table(f"{db}.u").filter("source = 'REAL-TIME'").count() == 0


def test_aligned_unified_counts_each_event_at_most_once(spark):
    from tidemark.operators.metrics import batch_metrics, speed_metrics
    from tidemark.sources.adapters import tweets
    t = tweets(spark, "/root/testdata/sf0.001")
    n = t.count()
    aligned = S.unified(batch_metrics(t, time_mode="instant"), speed_metrics(t))
    assert aligned.agg(F.sum("tweet_count")).first()[0] <= n
    faithful = S.unified(batch_metrics(t), speed_metrics(t))
    assert faithful.agg(F.sum("tweet_count")).first()[0] >= n   # the wall/instant gap counts some twice


def test_sql_view_over_partitioned_speed_table(spark, db):
    batch = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    batch.write.saveAsTable(f"{db}.b2")
    S.create_speed_table(spark, f"{db}.s2")
    speed = [metric("a", T(10, 59), T(11)), metric("a", T(11), T(11, 1)),
             metric("b", dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6)),
             metric("c", dt.datetime(2024, 1, 3, 0), dt.datetime(2024, 1, 3, 0, 1)),
             metric("d", T(12), None)]                     # open end: NULL date partition, still served
    S.append_speed(spark.createDataFrame(speed, METRICS_TABLE), f"{db}.s2", 0)
    S.create_unified_view(spark, f"{db}.u2", f"{db}.b2", f"{db}.s2")
    key = lambda r: (r.source, r.airline, r.window_start)
    via_sql = sorted(spark.table(f"{db}.u2").collect(), key=key)
    via_df = sorted(S.unified(spark.table(f"{db}.b2"), spark.table(f"{db}.s2")).collect(), key=key)
    assert via_sql == via_df
    assert [(r.source, r.airline) for r in via_sql] == [("BATCH", "a"), ("REAL-TIME", "a"), ("REAL-TIME", "c"),
                                                       ("REAL-TIME", "d")]


def test_publish_refuses_older_versions_and_keeps_its_own(spark, db):
    name = f"{db}.batch"
    rows = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    for v in (1000, 2000):
        S.publish_version(rows, name, version=v)
    with pytest.raises(ValueError):
        S.publish_version(rows, name, version=5)
    assert spark.table(name).count() == 1 and S.current_version(spark, name) == 2000
    assert S.publish_version(rows, name, keep=0) > 2000 and spark.table(name).count() == 1
    assert S.published_end(spark, name) == "2024-01-02 11:00:00"
    assert len(S.versions(spark, name)) == 1


def test_pinned_view_needs_no_scan_for_the_cut(spark, db):
    batch = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    S.publish_version(batch, f"{db}.batch")
    S.create_speed_table(spark, f"{db}.s")
    S.append_speed(spark.createDataFrame([metric("a", T(10, 59), T(11)), metric("b", T(11), T(11, 1))], METRICS_TABLE), f"{db}.s", 0)
    S.create_unified_view(spark, f"{db}.u", f"{db}.batch", f"{db}.s", pin=True)
    u = spark.table(f"{db}.u")
    assert sorted((r.source, r.airline) for r in u.collect()) == [("BATCH", "a"), ("REAL-TIME", "b")]
    assert "Subquery" not in u._jdf.queryExecution().executedPlan().toString()


def test_publish_writes_few_files(spark, db):
    rows = [metric(f"k{i % 7}", dt.datetime(2024, 1 + i % 3, 2, i % 24), dt.datetime(2024, 1 + i % 3, 2, i % 24, 30)) for i in range(600)]
    S.publish_version(spark.createDataFrame(rows, METRICS_TABLE).repartition(30), f"{db}.batch", version=1)
    files = spark.table(f"{db}.batch_v1").select("window_month", "_metadata.file_path").distinct().groupBy("window_month").count().collect()
    assert len(files) == 3 and all(r["count"] <= 2 for r in files)


def test_two_writers_share_batch_ids(spark, db):
    S.create_speed_table(spark, f"{db}.speed")
    rows = spark.createDataFrame([metric("a", T(10), T(11))], METRICS_TABLE)
    assert S.append_speed(rows, f"{db}.speed", 0, writer="one") and S.append_speed(rows, f"{db}.speed", 0, writer="two")
    assert not S.append_speed(rows, f"{db}.speed", 0, writer="one")
    assert spark.table(f"{db}.speed").count() == 2


def test_a_cut_off_overwrite_is_finished(spark, db, monkeypatch):
    """A crash after the first of two partitions loses nothing: the next call completes it."""
    from tidemark.operators import tables as TB
    table = f"{db}.speed"
    S.create_speed_table(spark, table)
    day = lambda d: metric("a", dt.datetime(2024, 1, d, 9), dt.datetime(2024, 1, d, 10))
    S.append_speed(spark.createDataFrame([day(1), day(2)], METRICS_TABLE), table, 0)
    new = spark.table(table).withColumn("tweet_count", F.lit(5).cast("bigint"))
    whole = TB.overwrite_partitions

    def dies(df, t):
        whole(df.filter("window_date = '2024-01-01'"), t)
        TB.drop_partitions(spark, t, [{"window_date": "2024-01-02"}])   # deleted, not yet replaced
        raise RuntimeError("executor host gone")

    monkeypatch.setattr(TB, "overwrite_partitions", dies)
    with pytest.raises(RuntimeError):
        TB.overwrite_safely(new, table)
    monkeypatch.setattr(TB, "overwrite_partitions", whole)
    assert spark.table(table).count() == 1
    assert TB.finish_overwrite(spark, table) and not TB.finish_overwrite(spark, table)
    assert [r.tweet_count for r in spark.table(table).collect()] == [5, 5]


ZONE_PROBE = """
import datetime as dt, sys
sys.path.insert(0, {root!r})
from tidemark.session import build_session, scratch_database
from tidemark.operators import serving as S
from tidemark.schemas import METRICS_TABLE
spark = build_session(master="local[2]", shuffle_partitions=2, extra={{"spark.sql.warehouse.dir": {wh!r}}})
m = lambda h: ("a", 1, 1, 0, 0, 1.0, 0.0, 1.0, 1, 0.1, "2024-01-02 %02d:00:00" % h, "2024-01-02 %02d:30:00" % h)
cols = ", ".join(f.name + " " + ("string" if f.name.startswith("window") else f.dataType.simpleString()) for f in METRICS_TABLE.fields)
rows = spark.createDataFrame([m(h) for h in range(24)], cols)
rows = rows.select(*[rows[f.name].cast(f.dataType) for f in METRICS_TABLE.fields])
t = scratch_database(spark, "zone") + ".speed"
S.create_speed_table(spark, t)
S.append_speed(rows, t, 0, now=dt.datetime(2024, 1, 3))
n = S.prune_speed(spark, t, S.max_window_end(rows.where("window_end <= timestamp_ntz'2024-01-02 09:30:00'")))
r = S.time_range(rows, dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 2, 7), month_col="none").count()
print("RESULT", n, spark.table(t).count(), r, spark.table(t).selectExpr("min(cast(created_at as string))").first()[0])
"""


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
def test_times_do_not_pass_through_the_process_zone(tmp, zone):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ZONE_PROBE.format(root=root, wh=os.path.join(tmp, "wh"))
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "TZ": zone}, capture_output=True, text=True, timeout=300)
    assert "RESULT 10 14 3 2024-01-03 00:00:00" in out.stdout, out.stdout[-500:] + out.stderr[-2000:]


def test_an_archive_exists_at_all_times(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "arch")
    one = spark.createDataFrame([metric("007", T(10), T(11))], METRICS_TABLE)
    two = spark.createDataFrame([metric("a", T(10), T(11)), metric("b", T(10), T(11))], METRICS_TABLE)
    one.write.partitionBy("airline").parquet(path)            # as an earlier release left it
    assert [r.airline for r in S.read_archive(spark, path).collect()] == ["007"]
    first = S.archive(one, path)
    reader = S.read_archive(spark, path)                      # planned before the next version
    half = os.path.join(path, "version-000000000000001")
    two.write.partitionBy("airline").parquet(half)
    os.remove(os.path.join(half, S.COMPLETE))                 # a writer that was cut off
    assert S.read_archive(spark, path).count() == 1 and S.archive_versions(spark, path) == [first]
    second = S.archive(two, path)
    assert reader.count() == 1 and S.read_archive(spark, path).count() == 2 and not os.path.exists(half)
    third = S.archive(one, path)
    assert S.archive_versions(spark, path) == [second, third] and [r.airline for r in S.read_archive(spark, path).collect()] == ["007"]
