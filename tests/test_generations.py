import os
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts as AL
from tidemark.operators import generations as G

SCHEMA = "tweet_id string, text string, timestamp long, partition int, offset long"


def updates(spark, recs):
    return spark.createDataFrame(recs, SCHEMA)


def waves(n=60, partitions=3):
    """Three deliveries of records over three partitions: the last third, the first two, some again."""
    recs = [(str(k % 11) if k % 13 else None, f"t{k}", 1000 + (k * 37) % n, k % partitions, k // partitions) for k in range(n)]
    return recs, [recs[40:], recs[:40], recs[10:50:3]]


def winners(recs):
    best = {}
    for r in recs:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: x[2:])
    return sorted((r[:2] for r in best.values()), key=str)


def got(df):
    return sorted(((r.tweet_id, r.text) for r in df.collect()), key=str)


def test_an_older_record_never_wins_across_partitions_and_batches(spark, tmp):
    recs, deliveries = waves()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reg LOCATION '{os.path.join(tmp, 'db')}'")
    for d in [*deliveries, deliveries[0]]:
        AL.upsert(spark, "reg.alerts", updates(spark, d), order_cols=AL.RECORD_ORDER, buckets=4, columns=["tweet_id", "text"], register=True)
    assert got(spark.table("reg.alerts")) == winners(recs)
    with pytest.raises(ValueError):
        AL.upsert(spark, "reg.alerts", updates(spark, recs), columns=["tweet_id", "text"], register=True)


def test_a_table_without_register_gets_one(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reg2 LOCATION '{os.path.join(tmp, 'db')}'")
    put = lambda recs, **kw: AL.upsert(spark, "reg2.alerts", updates(spark, recs), order_cols=AL.RECORD_ORDER, buckets=2,
                                       columns=["tweet_id", "text"], **kw)
    put([("1", "old", 5, 0, 0), ("2", "old", 5, 0, 1)])
    put([("1", "new", 4, 0, 0)], register=True)
    put([("1", "older", 3, 0, 0), ("3", "x", 1, 0, 0)], register=True)
    assert got(spark.table("reg2.alerts")) == [("1", "new"), ("2", "old"), ("3", "x")]


def test_alert_query_keeps_the_register(spark, tmp):
    """Record times reach the table; a restart that delivers old records again changes nothing."""
    from tidemark.streaming.speed import run_available, start_alerts
    src = os.path.join(tmp, "in")
    base = "airline string, airline_sentiment string, retweet_count int, tweet_created string"
    rows = lambda recs: updates(spark, recs).selectExpr("*", "'a' airline", "'negative' airline_sentiment", "1 retweet_count", "'x' tweet_created")
    rows([("1", "late", 9, 0, 10), ("1", "early", 8, 1, 3)]).coalesce(1).write.parquet(src)
    schema = f"{SCHEMA}, {base}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reg3 LOCATION '{os.path.join(tmp, 'db')}'")
    for k, more in enumerate([None, [("1", "early", 8, 1, 3), ("2", "x", 1, 1, 4)]]):
        if more:
            rows(more).coalesce(1).write.mode("append").parquet(src)
        run_available(start_alerts(spark.readStream.schema(schema).parquet(src), "reg3.alerts", os.path.join(tmp, "ck"), trigger={"availableNow": True}, buckets=2))
    assert got(spark.table("reg3.alerts")) == [("1", "late"), ("2", "x")]


def test_merge_on_read(spark, tmp):
    recs, deliveries = waves()
    g = G.Generations(spark, os.path.join(tmp, "gens"), buckets=4)
    for k, d in enumerate(deliveries):
        assert g.upsert(updates(spark, d), AL.RECORD_ORDER, "q", k)
        assert not g.upsert(updates(spark, d), AL.RECORD_ORDER, "q", k)
    assert len(g.manifest()["live"]) == 3 and got(g.latest()) == winners(recs)
    reader = g.latest()                       # planned before the fold
    assert g.compact() and not g.compact()
    assert g.upsert(updates(spark, deliveries[1]), AL.RECORD_ORDER, "q", 3)
    assert got(reader) == winners(recs) == got(g.latest())
    assert g.vacuum() == 0 and g.vacuum(older_than_s=-1) == 3
    assert got(g.latest()) == winners(recs)
    want = [w for w in winners(recs) if w[0] in ("3", "7")]
    assert got(g.lookup("3", "7")) == want and g.lookup("none").collect() == []
    with pytest.raises(ValueError):
        g.upsert(updates(spark, recs).drop("text"), AL.RECORD_ORDER, "q", 4)


def test_a_cut_off_upsert_is_invisible(spark, tmp, monkeypatch):
    recs, deliveries = waves()
    g = G.Generations(spark, os.path.join(tmp, "gens"), buckets=4)
    g.upsert(updates(spark, deliveries[0]), AL.RECORD_ORDER, "q", 0)
    put = G.Generations._put

    def gone(*_):
        raise RuntimeError("host gone")

    monkeypatch.setattr(G.Generations, "_put", gone)
    for act in (lambda: g.upsert(updates(spark, deliveries[1]), AL.RECORD_ORDER, "q", 1), lambda: g.upsert(updates(spark, recs[:1]), AL.RECORD_ORDER, "q", 1)):
        with pytest.raises(RuntimeError):
            act()
        assert got(g.latest()) == winners(deliveries[0])
    monkeypatch.setattr(G.Generations, "_put", put)
    g.upsert(updates(spark, deliveries[1]), AL.RECORD_ORDER, "q", 1)
    assert got(g.latest()) == winners(recs)


def test_many_upserts_fold_and_lookups_skip_row_groups(spark, tmp, monkeypatch):
    monkeypatch.setattr(G, "FOLD_AT", 4)
    g = G.Generations(spark, os.path.join(tmp, "gens"), buckets=2)
    for k in range(9):
        g.upsert(updates(spark, [(f"k{k}", f"t{k}", k, 0, k), ("all", f"t{k}", k, 0, k)]), AL.RECORD_ORDER, "q", k)
    assert len(g.manifest()["live"]) <= 4 and got(g.latest()) == [("all", "t8"), *((f"k{k}", f"t{k}") for k in range(9))]
    plan = g.lookup("k3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", plan) and "EqualTo(tweet_id,k3)" in plan
    import pyarrow.parquet as pq
    big = G.Generations(spark, os.path.join(tmp, "big"), buckets=1)
    big.upsert(spark.range(5000).select(F.format_string("%08d", F.col("id") * 2).alias("tweet_id"), F.col("id").alias("n")), ("n",))
    file = next(os.path.join(d, f) for d, _, fs in os.walk(os.path.join(tmp, "big")) for f in fs if f.endswith(".parquet"))
    assert pq.ParquetFile(file).metadata.num_rows == 5000
    absent, there = big.lookup("00005001"), big.lookup("00005000")
    assert absent.collect() == [] and there.count() == 1
    counts = []
    for df in (absent, there):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        counts.append(scan.metrics().apply("numOutputRows").value())
    assert counts[0] == 0 and counts[1] > 0       # the Bloom filter leaves no row group to read
