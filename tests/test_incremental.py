import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.functions import parse_wall
from tidemark.operators.metrics import batch_metrics, partial_metrics
from tidemark.plans.batch_cycle import CycleConfig, run_batch_cycle
from tidemark.plans.incremental import batch_metrics_from_partials, merge_partials, update_batch_partials
from tidemark.schemas import TWEET
from tidemark.sources.lake import read_raw, write_raw

from .conftest import rows


def tweets(spark, start, n, step_s=700):
    base = dt.datetime(2015, 2, 24, 10, 0)
    recs = []
    for i in range(start, start + n):
        t = base + dt.timedelta(seconds=i * step_s)
        recs.append((str(i), ["a", "b", None][i % 3], ["positive", "negative", "neutral", "x", None][i % 5], "t",
                     None if i % 7 == 0 else i % 11, t.strftime("%Y-%m-%d %H:%M:%S") + " -0800"))
    recs.append((f"bad{start}", "a", "positive", "t", 1, "garbage"))
    return spark.createDataFrame(recs, TWEET)


def test_incremental_equals_full_after_each_append(spark, tmp):
    lake, ckpt = os.path.join(tmp, "lake"), os.path.join(tmp, "ck")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc LOCATION '{os.path.join(tmp, 'db')}'")
    table = "inc.partials"
    for start in (0, 40, 20):        # the third append falls into hours already seen
        write_raw(tweets(spark, start, 30), lake, now="2024-01-01 00:00:00")
        update_batch_partials(spark, lake, table, ckpt)
        assert rows(batch_metrics_from_partials(spark, table)) == rows(batch_metrics(read_raw(spark, lake)))


def test_replayed_batch_is_skipped(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc2 LOCATION '{os.path.join(tmp, 'db')}'")
    table = "inc2.partials"
    p = partial_metrics(tweets(spark, 0, 20), parse_wall("tweet_created"))
    assert merge_partials(spark, table, p, 0)
    assert merge_partials(spark, table, p, 1)
    before = rows(spark.table(table))
    assert merge_partials(spark, table, p, 1) is False
    assert rows(spark.table(table)) == before
    assert spark.table(table).agg(F.sum("tweet_count")).first()[0] == 40


def test_cycle_incremental_matches_full(spark, tmp):
    lake = os.path.join(tmp, "lake")
    write_raw(tweets(spark, 0, 50), lake, now="2024-01-01 00:00:00")
    out = {}
    for inc in (False, True):
        db = f"cyc_{int(inc)}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp, db)}'")
        cfg = CycleConfig(lake_path=lake, database=db, archive_path=os.path.join(tmp, f"arch{int(inc)}"),
                          incremental=inc, partials_checkpoint=os.path.join(tmp, f"pck{int(inc)}"),
                          lake_stats_checkpoint=os.path.join(tmp, f"lck{int(inc)}"))
        report = run_batch_cycle(spark, cfg)
        out[inc] = rows(spark.table(f"{db}.batch_tweet_metrics").drop("window_month"))
        out[("report", inc)] = sorted(tuple(r) for r in report.collect())
        checks = {r.check for r in report.collect() if r.layer == "batch"}
        assert "row count > 0" in checks
    assert out[False] == out[True]
    assert out[("report", False)] == out[("report", True)]


def test_partials_refuse_a_foreign_checkpoint(spark, tmp):
    import pytest
    lake = os.path.join(tmp, "lake")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc3 LOCATION '{os.path.join(tmp, 'db')}'")
    write_raw(tweets(spark, 0, 10), lake, now="2024-01-01 00:00:00")
    update_batch_partials(spark, lake, "inc3.p", os.path.join(tmp, "ck1"))
    with pytest.raises(ValueError):
        update_batch_partials(spark, lake, "inc3.p", os.path.join(tmp, "ck2"))


def test_incremental_lake_check_equals_full_scan(spark, tmp):
    from tidemark.operators.quality import check_lake
    from tidemark.plans.incremental import check_lake_from_stats, update_lake_stats

    from .test_quality import lake_file
    lake, ck = os.path.join(tmp, "lake"), os.path.join(tmp, "ck")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc4 LOCATION '{os.path.join(tmp, 'db')}'")
    waves = [("f1.parquet", [("1", "a", "positive", "t", 1, "x", "i")], ()),
             ("f2.parquet", [("2", None, "Mixed", "t", 1, "x", "i"), (None, "b", None, "t", 0, "x", "i")],
              ("ingested_at",)),
             ("f3.parquet", [("3", "c", "zzz", "t", 1, "x", "i"), ("4", "c", "negative", "t", 1, "x", "i")], ())]
    for name, recs, drop in waves:
        lake_file(lake, name, recs, drop=drop)
        update_lake_stats(spark, lake, "inc4.stats", ck, max_files_per_trigger=1)
        full = sorted(tuple(r) for r in check_lake(spark, lake).collect())
        inc = sorted(tuple(r) for r in check_lake_from_stats(spark, "inc4.stats").collect())
        assert inc == full
    assert spark.table("inc4.stats").count() == 3


def test_a_fold_that_dies_after_one_month_is_completed(spark, tmp, monkeypatch):
    import pytest

    from tidemark.operators import tables as TB
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc5 LOCATION '{os.path.join(tmp, 'db')}'")
    table = "inc5.partials"
    recs = [(str(i), "a", "positive", "t", 1, f"2015-{1 + i % 3:02d}-10 10:00:00 -0800") for i in range(9)]
    p = partial_metrics(spark.createDataFrame(recs, TWEET), parse_wall("tweet_created"))
    merge_partials(spark, table, p, 0)
    whole = TB.overwrite_partitions

    def dies(df, t):
        whole(df.filter("window_month = '2015-01'"), t)
        raise RuntimeError("host gone")

    monkeypatch.setattr(TB, "overwrite_partitions", dies)
    with pytest.raises(RuntimeError):
        merge_partials(spark, table, p, 1)
    monkeypatch.setattr(TB, "overwrite_partitions", whole)
    assert merge_partials(spark, table, p, 1) is False       # completed, then seen to be folded
    assert sorted(r.tweet_count for r in spark.table(table).collect()) == [6, 6, 6]


def test_an_unreadable_file_fails_and_counts_once_repaired(spark, tmp):
    import pytest
    lake, ck = os.path.join(tmp, "lake"), os.path.join(tmp, "ck")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inc6 LOCATION '{os.path.join(tmp, 'db')}'")
    write_raw(tweets(spark, 0, 10), os.path.join(lake, "deep", "er"), now="2024-01-01 00:00:00")
    with open(os.path.join(lake, "half.parquet"), "wb") as f:
        f.write(b"PAR1 not whole")
    with pytest.raises(Exception):
        update_batch_partials(spark, lake, "inc6.p", ck)
    os.remove(os.path.join(lake, "half.parquet"))
    write_raw(tweets(spark, 20, 5), os.path.join(tmp, "fixed"), now="2024-01-01 00:00:00")
    fixed = [f for f in os.listdir(os.path.join(tmp, "fixed")) if f.endswith(".parquet")]
    for n, f in enumerate(fixed):
        os.rename(os.path.join(tmp, "fixed", f), os.path.join(lake, "half.parquet" if not n else f))
    update_batch_partials(spark, lake, "inc6.p", ck)
    assert rows(batch_metrics_from_partials(spark, "inc6.p")) == rows(batch_metrics(read_raw(spark, lake)))
