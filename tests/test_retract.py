import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators.metrics import batch_metrics
from tidemark.plans import retract as RT
from tidemark.schemas import TWEET
from tidemark.sources.lake import read_raw, write_raw

from .conftest import rows
from .test_incremental import tweets

NOW = "2024-01-01 00:00:00"


def wave(spark, lake, name, start, n, step=700):
    write_raw(tweets(spark, start, n, step).coalesce(2), os.path.join(lake, name), now=NOW)


def setup(spark, tmp, name):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{os.path.join(tmp, 'db')}'")
    return os.path.join(tmp, "la ke+%20"), RT.FilePartials(f"{name}.partials")


def same_as_full(spark, lake, p):
    spark.catalog.clearCache()
    assert rows(RT.metrics_by_file(spark, p)) == rows(batch_metrics(read_raw(spark, lake)))


def test_files_come_leave_and_are_repaired(spark, tmp):
    lake, p = setup(spark, tmp, "retract1")
    wave(spark, lake, "a", 0, 40)
    wave(spark, lake, "b/deep", 20, 40)           # the hours of a
    wave(spark, lake, "c", 5000, 30)              # another month
    assert RT.update_by_file(spark, lake, p, max_files=2) == 6
    same_as_full(spark, lake, p)
    assert RT.update_by_file(spark, lake, p) == 0
    shutil.rmtree(os.path.join(lake, "b"))        # rows of hours that others have too: maxima are rebuilt
    assert RT.update_by_file(spark, lake, p) == 2
    same_as_full(spark, lake, p)
    shutil.rmtree(os.path.join(lake, "c"))        # a month that only c had is gone
    wave(spark, lake, "d", 100, 10)
    RT.update_by_file(spark, lake, p)
    same_as_full(spark, lake, p)
    assert spark.table(p.name).select("window_month").distinct().count() == 1
    folder = os.path.join(lake, "a")
    names = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    wave(spark, os.path.join(tmp, "other"), "x", 300, 25, 900)
    fixed = sorted(f for f in os.listdir(os.path.join(tmp, "other", "x")) if f.endswith(".parquet"))
    shutil.copyfile(os.path.join(tmp, "other", "x", fixed[0]), os.path.join(folder, names[0]))   # same path, other rows
    for f in os.listdir(folder):
        if f.endswith(".crc"):
            os.remove(os.path.join(folder, f))
    assert RT.update_by_file(spark, lake, p) == 2
    same_as_full(spark, lake, p)
    shutil.rmtree(lake)
    os.makedirs(lake)
    RT.update_by_file(spark, lake, p)
    assert RT.metrics_by_file(spark, p).collect() == [] and spark.table(p.files).count() == 0


@pytest.mark.parametrize("step", [1, 3])
def test_an_update_that_is_cut_off_is_completed(spark, tmp, monkeypatch, step):
    lake, p = setup(spark, tmp, f"retract_cut{step}")
    wave(spark, lake, "a", 0, 40)
    wave(spark, lake, "b", 20, 40)
    RT.update_by_file(spark, lake, p)
    shutil.rmtree(os.path.join(lake, "b"))
    wave(spark, lake, "c", 30, 20)
    wave(spark, lake, "d", 5000, 20)
    calls = []

    def dies(real):
        def run(*args):
            calls.append(1)
            real(*args)
            if len(calls) == step:
                raise RuntimeError("host gone")
        return run

    real_replace, real_append = RT._replace, RT._append_once
    monkeypatch.setattr(RT, "_replace", dies(real_replace))
    monkeypatch.setattr(RT, "_append_once", dies(real_append))
    with pytest.raises(RuntimeError):
        RT.update_by_file(spark, lake, p)
    monkeypatch.setattr(RT, "_replace", real_replace)
    monkeypatch.setattr(RT, "_append_once", real_append)
    RT.update_by_file(spark, lake, p)
    same_as_full(spark, lake, p)
    assert spark.table(p.by_file).groupBy("file", "window_start", "airline").count().where("count > 1").count() == 0
    assert spark.table(p.by_file).agg(F.sum("tweet_count")).first()[0] == spark.table(p.name).agg(F.sum("tweet_count")).first()[0]


def test_an_unreadable_file_changes_nothing(spark, tmp):
    lake, p = setup(spark, tmp, "retract2")
    wave(spark, lake, "a", 0, 10)
    RT.update_by_file(spark, lake, p)
    before = rows(RT.metrics_by_file(spark, p))
    with open(os.path.join(lake, "half.parquet"), "wb") as f:
        f.write(b"PAR1 not whole")
    with pytest.raises(Exception):
        RT.update_by_file(spark, lake, p)
    assert rows(RT.metrics_by_file(spark, p)) == before
    os.remove(os.path.join(lake, "half.parquet"))
    assert RT.update_by_file(spark, lake, p) == 0


def test_rows_without_a_time_or_key(spark, tmp):
    lake, p = setup(spark, tmp, "retract3")
    recs = [("1", None, None, None, None, "2015-02-24 10:00:00 -0800"), ("2", "a", "positive", "t", None, "garbage"), ("3", None, "x", "t", 5, "2015-02-24 10:10:00 -0800")]
    write_raw(spark.createDataFrame(recs, TWEET).coalesce(1), os.path.join(lake, "a"), now=NOW)
    write_raw(spark.createDataFrame(recs[:1], TWEET).coalesce(1), os.path.join(lake, "b"), now=NOW)
    RT.update_by_file(spark, lake, p)
    same_as_full(spark, lake, p)
    shutil.rmtree(os.path.join(lake, "a"))
    RT.update_by_file(spark, lake, p)
    same_as_full(spark, lake, p)


def test_the_cycle_follows_a_file_that_leaves(spark, tmp):
    from tidemark.plans.batch_cycle import CycleConfig, run_batch_cycle
    lake, _ = setup(spark, tmp, "retract4")
    wave(spark, lake, "a", 0, 20)
    wave(spark, lake, "b", 10, 20)
    cfg = CycleConfig(lake_path=lake, database="retract4", archive_path=os.path.join(tmp, "arch"), by_file=True)
    for gone in (None, "b"):
        if gone:
            shutil.rmtree(os.path.join(lake, gone))
        run_batch_cycle(spark, cfg)
        assert rows(spark.table("retract4.batch_tweet_metrics").drop("window_month")) == rows(batch_metrics(read_raw(spark, lake)))
