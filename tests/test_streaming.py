"""Micro-streams with fixed batch boundaries: one file per micro-batch."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq

from tidemark.schemas import TWEET
from tidemark.sources.lake import file_stream
from tidemark.sources.wire import decode_json, encode_json, observe_ingest, skip_bad
from tidemark.streaming.speed import (IngestTotals, run_available, speed_session, start_alerts, start_metrics,
                                      start_metrics_wire, state_rows)

# (key, minute:second after 11:00) per file, in arrival order
ARRIVALS = [[("a", "00:01"), ("a", "00:59")],
            [("a", "01:04")],            # window 11:00-11:01 still open
            [("a", "00:30")],            # within tolerance
            [("a", "01:05")],            # max event time reaches end + 5 s
            [("a", "00:10")],            # arrives in the closing batch: still counted
            [("a", "01:06")],
            [("a", "00:20")],            # two batches later: dropped
            [("b", "09:00")]]            # moves the watermark; its own window stays open


def write_files(folder, arrivals, start=0):
    os.makedirs(folder, exist_ok=True)
    schema = pa.schema([("tweet_id", pa.string()), ("airline", pa.string()), ("airline_sentiment", pa.string()),
                        ("text", pa.string()), ("retweet_count", pa.int32()), ("tweet_created", pa.string())])
    n = 0
    for i, batch in enumerate(arrivals, start=start):
        recs = []
        for key, ms in batch:
            n += 1
            recs.append({"tweet_id": f"{i}-{n}", "airline": key, "airline_sentiment": "negative", "text": "t",
                         "retweet_count": 1, "tweet_created": f"2015-02-24 11:{ms} +0000"})
        p = os.path.join(folder, f"part-{i:03d}.parquet")
        pq.write_table(pa.Table.from_pylist(recs, schema), p)
        os.utime(p, (1_000_000 + i * 10, 1_000_000 + i * 10))


def counts(spark, path):
    return sorted((r.airline, r.window_start, r.tweet_count) for r in spark.read.parquet(path).collect())


EXPECTED = [("a", "2015-02-24T11:00:00Z", 4), ("a", "2015-02-24T11:01:00Z", 3)]


def test_watermark_closing_and_late_rows(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    raw = file_stream(spark, src, TWEET, max_files_per_trigger=1)
    q = run_available(start_metrics_wire(raw, os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                                         trigger={"availableNow": True}))
    assert counts(spark, os.path.join(tmp, "out")) == EXPECTED
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 1
    # closed windows were evicted: only key b's open window is left in state
    assert state_rows(q) == 1


def test_restart_from_checkpoint_gives_same_result(spark, tmp):
    src = os.path.join(tmp, "in")
    out, ck = os.path.join(tmp, "out"), os.path.join(tmp, "ck")
    write_files(src, ARRIVALS[:2])
    run_available(start_metrics_wire(file_stream(spark, src, TWEET, max_files_per_trigger=1), out, ck,
                                     trigger={"availableNow": True}))
    assert counts(spark, out) == []
    write_files(src, ARRIVALS[2:], start=2)
    run_available(start_metrics_wire(file_stream(spark, src, TWEET, max_files_per_trigger=1), out, ck,
                                     trigger={"availableNow": True}))
    assert counts(spark, out) == EXPECTED


def test_speed_table_sink_and_alert_branch(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    db = "stream_t"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp, 'db')}'")
    raw = file_stream(spark, src, TWEET, max_files_per_trigger=1)
    run_available(start_metrics(raw, f"{db}.speed", os.path.join(tmp, "ck1"), trigger={"availableNow": True},
                                now="2024-01-01 00:00:00"))
    got = sorted((r.airline, r.tweet_count) for r in spark.table(f"{db}.speed").collect())
    assert got == [("a", 3), ("a", 4)]
    # the alert branch has no watermark: every negative row is an alert, late or not
    run_available(start_alerts(raw, f"{db}.alerts", os.path.join(tmp, "ck2"), trigger={"availableNow": True},
                               buckets=4))
    assert spark.table(f"{db}.alerts").count() == sum(len(b) for b in ARRIVALS)


def test_ingest_counters_on_a_stream(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS[:3])
    raw = file_stream(spark, src, TWEET)
    msgs = encode_json(raw).selectExpr("CASE WHEN value LIKE '%00:59%' THEN 'junk' ELSE value END AS value")
    decoded = skip_bad(observe_ingest(decode_json(msgs), "ingest"))
    totals = IngestTotals()
    spark.streams.addListener(totals)
    q = run_available(decoded.writeStream.format("memory").queryName("ingest_t")
                      .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    assert spark.table("ingest_t").count() == 3
    for _ in range(100):
        if totals.of(q):
            break
        time.sleep(0.1)
    spark.streams.removeListener(totals)
    assert totals.of(q) == {"saved": 3, "skipped": 1}


def test_ingest_totals_hold_every_batch():
    """A query itself remembers its last 100 micro-batches; the totals all of them."""
    class Row:
        def asDict(self):
            return {"saved": 2, "skipped": 1}

    class Event:
        class progress:
            id = "q"
            observedMetrics = {"ingest": Row()}

    class Query:
        id = "q"

    totals = IngestTotals()
    for _ in range(250):
        totals.onQueryProgress(Event)
    assert totals.of(Query) == {"saved": 500, "skipped": 250} and totals.of(Query, "other") == {}


def test_a_new_checkpoint_is_a_new_writer(spark, tmp):
    """Batch ids start at 0 again under a new checkpoint; its rows are no replay."""
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wr LOCATION '{os.path.join(tmp, 'db')}'")
    for k in range(2):
        raw = file_stream(spark, src, TWEET, max_files_per_trigger=1)
        run_available(start_metrics(raw, "wr.speed", os.path.join(tmp, f"ck{k}"), trigger={"availableNow": True}))
    assert sorted(r.tweet_count for r in spark.table("wr.speed").collect()) == [3, 3, 4, 4]


def test_topic_position_reaches_the_upsert(spark, tmp):
    """Last arrival by partition and offset, through decoding."""
    import json

    from tidemark.operators.alerts import upsert
    base = {"airline": "a", "airline_sentiment": "negative", "retweet_count": 1, "tweet_created": "x"}
    rows = [(json.dumps({**base, "tweet_id": "1", "text": f"offset {o}"}), 0, o) for o in (7, 9, 8)]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tp LOCATION '{os.path.join(tmp, 'db')}'")
    d = skip_bad(decode_json(spark.createDataFrame(rows, "value string, partition int, offset long")))
    assert {"partition", "offset"} <= set(d.columns)
    upsert(spark, "tp.alerts", d, order_cols=("partition", "offset"), buckets=2)
    assert [r.text for r in spark.table("tp.alerts").collect()] == ["offset 9"]


def test_lake_append_exactly_once_across_restarts(spark, tmp):
    from tidemark.sources.lake import append_raw, read_raw
    src, lake, ck = os.path.join(tmp, "in"), os.path.join(tmp, "lake"), os.path.join(tmp, "ck")
    write_files(src, ARRIVALS[:3])
    for _ in range(2):       # the second run finds nothing new: no duplicates
        run_available(append_raw(file_stream(spark, src, TWEET), lake, ck, now="2024-01-01 00:00:00",
                                 trigger={"availableNow": True}))
    assert read_raw(spark, lake).count() == 4
    write_files(src, ARRIVALS[3:], start=3)
    run_available(append_raw(file_stream(spark, src, TWEET), lake, ck, now="2024-01-01 00:00:00",
                             trigger={"availableNow": True}))
    lake_rows = read_raw(spark, lake)
    assert lake_rows.count() == sum(len(b) for b in ARRIVALS)
    assert lake_rows.select("tweet_id").distinct().count() == lake_rows.count()
    assert lake_rows.first().ingested_at == "2024-01-01T00:00:00.000000+00:00"


def test_speed_layer_two_branches(spark, tmp):
    from tidemark.streaming.speed import start_speed_layer
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sl LOCATION '{os.path.join(tmp, 'db')}'")
    raw = file_stream(spark, src, TWEET, max_files_per_trigger=1)
    m, a = start_speed_layer(raw, "sl.speed", "sl.alerts", os.path.join(tmp, "ck"), trigger={"availableNow": True},
                             buckets=4)
    run_available(m)
    run_available(a)
    assert sorted(r.tweet_count for r in spark.table("sl.speed").collect()) == [3, 4]
    assert spark.table("sl.alerts").count() == sum(len(b) for b in ARRIVALS)


def test_state_partitions_fixed_at_start(spark, tmp):
    src = os.path.join(tmp, "in")
    write_files(src, ARRIVALS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = speed_session(spark, 2)
    q = run_available(start_metrics_wire(file_stream(own, src, TWEET, max_files_per_trigger=4),
                                         os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                                         trigger={"availableNow": True}))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    parts = [op.get("numStateStoreInstances") or op.get("numShufflePartitions")
             for p in q.recentProgress for op in (p.get("stateOperators") or [])]
    assert parts and set(parts) == {2}
    assert counts(spark, os.path.join(tmp, "out"))[0][2] >= 1


def test_a_streamed_date_is_one_file_whatever_the_state_partitions(spark, tmp):
    """The windows of a date leave all state partitions, and still go to one file; the
    query goes on from its checkpoint with the state partitions it began with."""
    src, ck = os.path.join(tmp, "in"), os.path.join(tmp, "ck")
    os.makedirs(src)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS few LOCATION '{os.path.join(tmp, 'db')}'")
    for run, days in enumerate([(1, 2, 3), (4, 5, 6)]):
        recs = [{"tweet_id": f"{d}-{k}", "airline": f"k{k}", "airline_sentiment": "negative", "text": "t", "retweet_count": 1,
                 "tweet_created": f"2015-02-{d:02d} 11:00:00 +0000"} for d in days for k in range(40)]
        t = pa.Table.from_pylist(recs)
        t = t.set_column(t.column_names.index("retweet_count"), "retweet_count", t["retweet_count"].cast(pa.int32()))
        pq.write_table(t, os.path.join(src, f"part-{run}.parquet"))
        own = speed_session(spark, 8)
        q = run_available(start_metrics(file_stream(own, src, TWEET), "few.speed", ck, trigger={"availableNow": True}))
        parts = {op["numShufflePartitions"] for p in q.recentProgress for op in p["stateOperators"]}
        assert parts == {8} and state_rows(q) == 40                    # the last day's windows are open
    got = spark.table("few.speed").select("window_date", "airline", "tweet_count", "_metadata.file_path").collect()
    assert sorted((r.window_date, r.airline, r.tweet_count) for r in got) == \
        sorted((f"2015-02-{d:02d}", f"k{k}", 1) for d in range(1, 6) for k in range(40))
    assert len({(r.window_date, r.file_path) for r in got}) == 5
