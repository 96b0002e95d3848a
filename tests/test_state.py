import os

import pytest

from tidemark.operators.metrics import speed_metrics
from tidemark.schemas import TWEET
from tidemark.sources.lake import file_stream
from tidemark.streaming.speed import run_available, sources_session, start_metrics_wire, start_speed_layer
from tidemark.streaming.state import LateRows, open_windows

from .conftest import rows
from .test_streaming import ARRIVALS, counts, write_files


def run(spark, src, tmp, name="ck", n=1, **kw):
    raw = file_stream(spark, src, TWEET, max_files_per_trigger=n)
    return run_available(start_metrics_wire(raw, os.path.join(tmp, "out"), os.path.join(tmp, name), trigger={"availableNow": True}, **kw))


def test_open_windows_are_those_of_a_batch_aggregate(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS[:3])
    run(spark, src, tmp)
    assert rows(open_windows(spark, os.path.join(tmp, "ck"))) == rows(speed_metrics(spark.read.parquet(src)))
    write_files(src, ARRIVALS[3:], start=3)
    run(spark, src, tmp)
    left = open_windows(spark, os.path.join(tmp, "ck")).collect()
    assert [(r.airline, r.tweet_count) for r in left] == [("b", 1)]
    assert open_windows(spark, os.path.join(tmp, "ck"), batch_id=0).count() == 1     # the state after the first micro-batch


def test_late_rows_by_micro_batch(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    late = LateRows()
    spark.streams.addListener(late)
    q = run(spark, src, tmp)
    late.wait(q)
    spark.streams.removeListener(late)
    got = late.rows(spark, q).orderBy("batch").collect()
    assert [r.input_rows for r in got] == [len(b) for b in ARRIVALS]
    assert [r.dropped for r in got] == [0, 0, 0, 0, 0, 0, 1, 0]
    assert late.totals(q) == (sum(len(b) for b in ARRIVALS), 1)


def test_a_quiet_source(spark, tmp):
    busy, quiet = os.path.join(tmp, "busy"), os.path.join(tmp, "quiet")
    write_files(busy, [[("a", "00:01"), ("a", "01:30"), ("a", "02:30")]])
    write_files(quiet, [[("q", "00:02")]])
    closed = {}
    for policy in ("min", "max"):
        own = sources_session(spark, policy, 2)
        sources = [file_stream(own, f, TWEET) for f in (busy, quiet)]
        out = os.path.join(tmp, policy)
        run_available(start_metrics_wire(sources, out, os.path.join(tmp, f"ck-{policy}"), trigger={"availableNow": True}))
        closed[policy] = counts(spark, out)
    assert closed["min"] == [] and [c[0] for c in closed["max"]] == ["a", "a", "q"]
    with pytest.raises(ValueError):
        sources_session(spark, "median")


def test_speed_layer_sizes_its_state(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sls LOCATION '{os.path.join(tmp, 'db')}'")
    read = lambda s: file_stream(s, src, TWEET, max_files_per_trigger=4)
    m, a = start_speed_layer(read, "sls.speed", "sls.alerts", os.path.join(tmp, "ck"), trigger={"availableNow": True}, buckets=2,
                             spark=spark, state_partitions=3)
    run_available(m)
    run_available(a)
    parts = {op.get("numStateStoreInstances") or op.get("numShufflePartitions") for p in m.recentProgress for op in (p.get("stateOperators") or [])}
    assert parts == {3} and spark.table("sls.alerts").count() == sum(len(b) for b in ARRIVALS)
    with pytest.raises(ValueError):
        start_speed_layer(read(spark), "sls.speed", "sls.alerts", os.path.join(tmp, "ck2"), state_partitions=3)
