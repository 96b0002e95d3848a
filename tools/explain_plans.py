"""Write the physical plans of the headline operators to PLANS.md.

    python tools/explain_plans.py [sf_dir]

Each section shows ``explain("formatted")`` with a short note on what to
look for: pushed filters, pruned columns, partition filters, partial
aggregation, exchanges.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue().strip()


def main(argv) -> None:
    from pyspark.sql import functions as F

    from tidemark.operators import alerts as AL
    from tidemark.operators import metrics as M
    from tidemark.operators import serving as S
    from tidemark.plans import catalog as C
    from tidemark.session import build_session
    from tidemark.sources import adapters as A
    from tidemark.streaming import speed as SP

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    t = A.tweets(spark, sf)
    sections = []

    sections.append(("Batch metrics (AGG1)",
                     "Only the 4 needed columns are read; partial HashAggregate before the one Exchange on "
                     "(window, airline); final HashAggregate after it.",
                     plan_text(M.batch_metrics(t), "formatted")))
    sections.append(("Unified view in one pass (SRV1): the scan",
                     "The rows are scanned once, into minute partials with both clocks: partial aggregate before the one "
                     "Exchange.",
                     plan_text(M.two_clock_partials(t))))
    sections.append(("Unified view in one pass (SRV1): hours, minutes and cut-off from the stored partials",
                     "Only the small table of partials is read; the cut-off is one scalar subquery; the "
                     "`window_start >= cut-off` filter sits below the speed aggregation.",
                     plan_text(S.unified_in_one_pass(t))))
    from tidemark.operators.ordering import prefix_index
    sections.append(("Place of each row in its group's order (SRT1)",
                     "Rows come from the stored, range-partitioned sort; the window runs over the table of counts, a row "
                     "for each (partition, group), not over the rows.",
                     plan_text(prefix_index(t, ["tweet_created", "tweet_id"], by=["airline"]))))
    from tidemark.operators.generations import Generations
    from tidemark.session import scratch_path as fresh
    g = Generations(spark, fresh(spark, "plans-generations"), buckets=16)
    for k, part in enumerate(C.alert_deliveries(spark, sf)):
        g.upsert(part, AL.RECORD_ORDER, "plans", k)
    sections.append(("Merge-on-read lookup (JON1)",
                     "PartitionFilters on the key's bucket, PushedFilters on the key (row groups are skipped by their Bloom "
                     "filter); the newest row of the key by a partial aggregate.",
                     plan_text(g.lookup("8"))))
    pub = C.published_batch(spark, sf)
    sections.append(("Range scan of the published table (FLT4/SRV4)",
                     "PartitionFilters on window_month; PushedFilters on window_start.",
                     plan_text(S.time_range(spark.table(pub), "2024-01-10 00:00:00", "2024-01-20 23:59:59"))))
    alerts = C.alerts_table(spark, sf)
    a = spark.table(alerts)
    sections.append(("Latest alerts (SRT3)", "TakeOrderedAndProject: a top-k per task, no global sort.",
                     plan_text(AL.alerts_latest(a, 100))))
    sections.append(("Alerts of one airline (FLT6)",
                     "PushedFilters on airline: bucket files are sorted by (airline, created_at), so Parquet "
                     "row-group statistics skip non-matching groups.",
                     plan_text(AL.alerts_by_airline(a, "airline_0"))))
    ev = A.table(spark, sf, "events")
    first_hour = ev.filter(F.col("ts") < ev.select(F.min("ts") + F.expr("INTERVAL 1 HOUR")).scalar())
    # the updates of one micro-batch: the first hour of events
    u = AL.latest_per_key(AL.alert_filter(A.events_as_alert_updates(first_hour)), "tweet_id", ("event_id",))
    u = u.select(*AL.ALERT_COLUMNS, AL.bucket_of(F.col("tweet_id"), 16).alias("bucket")).checkpoint()
    touched = [r[0] for r in u.select("bucket").distinct().collect()]
    existing = a.filter(F.col("bucket").isin(touched)).select("tweet_id")
    matched = u.join(existing, "tweet_id", "left_semi")
    sections.append(("Upsert: which update keys exist already (STR10/JON1)",
                     "Only the touched buckets are listed (PartitionFilters: bucket IN (...)) and only the key "
                     "column is read (ReadSchema: tweet_id); new keys are then appended, and only buckets "
                     "holding a replaced key are rewritten.",
                     plan_text(matched)))
    from tidemark.plans.incremental import update_batch_partials
    from tidemark.session import scratch_database, scratch_path
    parts = f"{scratch_database(spark, 'plans')}.batch_partials"
    update_batch_partials(spark, C.lake_of(spark, sf), parts, scratch_path(spark, "plans-ckpt"))
    month = spark.table(parts).select("window_month").first()[0]
    sections.append(("Incremental partials: the months a batch touches (AGG1/AGG7)",
                     "Only the month partitions present in the new files are read and rewritten "
                     "(PartitionFilters: window_month IN (...)).",
                     plan_text(spark.table(parts).filter(F.col("window_month").isin([month])))))
    raw = A.events_as_tweets(C.events_stream(spark, sf))
    sections.append(("Speed stream (STR1-5)",
                     "Streaming aggregation: partial aggregate, Exchange, StateStoreRestore/Save with the "
                     "event-time watermark.",
                     plan_text(SP.speed_stream(raw))))

    out = ["# Physical plans of the headline operators", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` (local session; plans are the same shape "
           "at any scale, partition counts aside).", ""]
    for title, note, text in sections:
        out += [f"## {title}", "", note, "", "```", text, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
