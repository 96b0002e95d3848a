"""The README's wiring, end to end, on the smallest tables."""

import os

from pyspark.sql import functions as F

from tidemark import (CycleConfig, append_raw, file_stream, run_batch_cycle, start_speed_layer, summary)
from tidemark.operators.metrics import batch_metrics
from tidemark.schemas import TWEET
from tidemark.sources.adapters import tweets
from tidemark.streaming.speed import run_available

SF = "/root/testdata/sf0.001"


def test_stream_to_serving(spark, tmp):
    landing = os.path.join(tmp, "landing")
    t = tweets(spark, SF)
    t.write.parquet(landing)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS e2e LOCATION '{os.path.join(tmp, 'serving')}'")
    raw = file_stream(spark, landing, TWEET)
    now = {"availableNow": True}
    lake = os.path.join(tmp, "lake")
    run_available(append_raw(raw, lake, os.path.join(tmp, "ck", "lake"), trigger=now))
    m, a = start_speed_layer(raw, "e2e.tweet_metrics", "e2e.tweet_alerts", os.path.join(tmp, "ck", "speed"),
                             trigger=now, buckets=8)
    run_available(m)
    run_available(a)
    cfg = CycleConfig(lake_path=lake, database="e2e", archive_path=os.path.join(tmp, "archive"), incremental=True,
                      partials_checkpoint=os.path.join(tmp, "ck", "partials"),
                      lake_stats_checkpoint=os.path.join(tmp, "ck", "lakestats"))
    report = run_batch_cycle(spark, cfg)
    s = summary(report).first()
    assert (s.total, s.failed) == (29, 0)
    unified = spark.table("e2e.unified_metrics")
    batch = unified.filter("source = 'BATCH'")
    assert batch.count() == batch_metrics(t).count()
    assert batch.agg(F.sum("tweet_count")).first()[0] == t.count()
    # the speed rows that survive pruning all start at or after the last batch window
    cut = batch.agg(F.max("window_end")).first()[0]
    assert unified.filter("source = 'REAL-TIME'").filter(F.col("window_start") < F.lit(cut)).count() == 0
    assert spark.table("e2e.tweet_alerts").count() == t.filter("airline_sentiment = 'negative'").count()
