"""Speed layer as Structured Streaming queries.

One raw stream feeds two independent queries, each with its own checkpoint:

* metrics — event time from ``tweet_created`` (UTC instant), watermark with
  a bounded delay, 1-minute tumbling windows per airline, append mode: a
  window is emitted once the watermark passes its end, late rows are
  dropped by the state store, and the state of a closed window is evicted;
* alerts — the negative filter without any watermark, upserted by key in
  ``foreachBatch``.

Restarting a query from its checkpoint resumes from the committed offsets
and state; the sinks are idempotent per micro-batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.time import parse_instant
from ..operators.alerts import RECORD_ORDER, alert_filter, upsert
from ..operators.metrics import TWEET_SPEC, MetricSpec, to_wire, windowed_metrics
from ..operators.serving import append_speed, create_speed_table
from ..schemas import TWEET_FIELDS
from ..session import REQUIRED_CONF
from ..sources.wire import encode_json

DEFAULT_DELAY = "5 seconds"
DEFAULT_WIDTH = "1 minute"
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def with_event_time(df: DataFrame, col: str = "tweet_created", delay: str = DEFAULT_DELAY,
                    out: str = "event_time") -> DataFrame:
    """Assign the event time (zoned text → TIMESTAMP instant) and declare the
    watermark: max event time seen minus ``delay``. Rows whose time does not
    parse are dropped here (they cannot be placed in any window)."""
    return (df.withColumn(out, parse_instant(col))
              .filter(F.col(out).isNotNull())
              .withWatermark(out, delay))


def speed_stream(raw: DataFrame | list[DataFrame], width: str = DEFAULT_WIDTH, delay: str = DEFAULT_DELAY,
                 spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Streaming windowed metrics with the speed layer's null rules. Several sources
    have a watermark each; which of them closes windows is the policy of the session
    they are read in (``sources_session``)."""
    timed = [with_event_time(r, delay=delay) for r in (raw if isinstance(raw, list) else [raw])]
    rows = timed[0]
    for t in timed[1:]:
        rows = rows.unionByName(t)
    return windowed_metrics(rows, "event_time", width, "speed", spec)


#: Which of several sources' watermarks counts: the slowest (nothing of a slow source
#: is late), or the fastest (a source that has gone quiet holds no window open).
WATERMARK_POLICIES = ("min", "max")


def sources_session(spark: SparkSession, policy: str, state_partitions: int | None = None) -> SparkSession:
    """A session of its own in which to read the sources of one query under a
    watermark policy; see ``speed_session``."""
    if policy not in WATERMARK_POLICIES:
        raise ValueError(f"the watermark policy must be one of {WATERMARK_POLICIES}")
    own = speed_session(spark, state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    own.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    return own


def speed_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of its own for a stateful query: read the raw stream in it.

    A query's state partitions are fixed for the life of its checkpoint, at the
    shuffle partitions of the session it is read in. Size them to the source's
    parallelism (the state is one small row per open (window, key)), not to a
    batch job's shuffle. Catalog and tables are shared with ``spark``."""
    own = spark.newSession()
    for key in (*REQUIRED_CONF, "spark.checkpoint.dir"):
        if (value := spark.conf.get(key, None)) is not None and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, name: str | None):
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
    return w.queryName(name) if name else w


def _session_of(raw: DataFrame | list[DataFrame]) -> SparkSession:
    return (raw[0] if isinstance(raw, list) else raw).sparkSession


def start_metrics(raw: DataFrame | list[DataFrame], table: str, checkpoint: str, trigger: dict | None = None,
                  width: str = DEFAULT_WIDTH, delay: str = DEFAULT_DELAY, now=None,
                  name: str | None = None) -> StreamingQuery:
    """Metrics query writing each micro-batch into the speed table, under the
    query's id, so that a new checkpoint's batches are not taken for replays."""
    create_speed_table(_session_of(raw), table)
    metrics = speed_stream(raw, width, delay)

    def sink(batch: DataFrame, batch_id: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_speed(batch, table, batch_id, now, writer=writer)

    return _writer(metrics, checkpoint, trigger, name).outputMode("append").foreachBatch(sink).start()


def start_metrics_wire(raw: DataFrame | list[DataFrame], path: str, checkpoint: str, trigger: dict | None = None,
                       width: str = DEFAULT_WIDTH, delay: str = DEFAULT_DELAY,
                       name: str | None = None) -> StreamingQuery:
    """Metrics query publishing wire-shaped rows to a Parquet folder (the
    file stand-in for the metrics topic; exactly-once via the sink log)."""
    wire = to_wire(speed_stream(raw, width, delay))
    return _writer(wire, checkpoint, trigger, name).outputMode("append").format("parquet").start(path)


def start_alerts(raw: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                 key: str = "tweet_id", order_cols=RECORD_ORDER, buckets: int = 64,
                 name: str | None = None) -> StreamingQuery:
    """Alert query: negative rows upserted by ``key`` (last arrival wins).

    The arrival order is ``order_cols`` (a record's time, then its place in the
    topic), which the table keeps as a register: an older record that is delivered
    again never replaces a newer row, whatever partition and micro-batch it comes
    in. Where the stream has no such columns, it is the row order within a
    micro-batch, and a later micro-batch wins over an earlier one because it is
    applied later. No watermark: an alert is never late."""
    spark: SparkSession = raw.sparkSession
    alerts = alert_filter(raw)

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch
        if not all(c in b.columns for c in order_cols):
            b = b.withColumn("_arrival", F.monotonically_increasing_id())
            upsert(spark, table, b, key=key, order_cols=("_arrival",), buckets=buckets)
        else:
            upsert(spark, table, b, key=key, order_cols=tuple(order_cols), buckets=buckets, register=True)

    return _writer(alerts, checkpoint, trigger, name).outputMode("append").foreachBatch(sink).start()


def start_alert_publish(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        encode=encode_json, name: str | None = None) -> StreamingQuery:
    """Alert rows published as messages, without a watermark: filter, encode,
    write. ``encode`` makes the ``value`` column (``connectors.wire_value`` for
    framed Avro); the folder stands in for the alert topic, for which
    ``connectors.kafka_write_stream(encode(alert_filter(raw)), ...)`` is the same."""
    messages = encode(alert_filter(raw).select(*TWEET_FIELDS))
    return _writer(messages, checkpoint, trigger, name).outputMode("append").format("parquet").start(path)


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until an ``availableNow`` query has drained its input, however long
    that takes; with ``timeout_s``, stop the query and raise after that time."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
        if query.isActive:
            query.stop()
            raise TimeoutError(f"streaming query {query.name} did not finish in {timeout_s}s")
    if query.exception():
        raise query.exception()
    return query


def start_console(stream: DataFrame, checkpoint: str, trigger: dict | None = None,
                  num_rows: int = 20) -> StreamingQuery:
    """Print each micro-batch (debugging aid; the first ``num_rows`` rows)."""
    return (_writer(stream, checkpoint, trigger, None).format("console")
            .option("numRows", str(num_rows)).option("truncate", "false").start())


class IngestTotals(StreamingQueryListener):
    """Counters attached with ``observe(name, ...)`` (e.g. ``observe_ingest``),
    summed over every micro-batch of every query while this is registered with
    ``spark.streams.addListener``. (A query itself remembers only its last
    micro-batches.)"""

    def __init__(self):
        self._totals: dict = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            out = self._totals.setdefault((str(event.progress.id), name), {})
            for k, v in row.asDict().items():
                out[k] = out.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery, name: str = "ingest") -> dict:
        """The totals of one query so far (its events arrive shortly after each batch)."""
        return dict(self._totals.get((str(query.id), name), {}))


def state_rows(query: StreamingQuery) -> int | None:
    """Rows held in the state store after the last micro-batch."""
    p = query.lastProgress
    if not p or not p.get("stateOperators"):
        return None
    return sum(op.get("numRowsTotal", 0) for op in p["stateOperators"])


def start_speed_layer(raw: DataFrame | Callable[[SparkSession], DataFrame], speed_table: str, alerts_table: str, checkpoint_root: str,
                      trigger: dict | None = None, buckets: int = 64, spark: SparkSession | None = None,
                      state_partitions: int | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Both speed-layer branches from one raw stream: the watermarked metrics
    into the speed table and the alert upsert (no watermark). Each is its own
    query with its own checkpoint below ``checkpoint_root``, so either can be
    restarted alone.

    The metrics' state partitions are fixed for the life of the checkpoint. To size
    them to the source, whatever the session's shuffle partitions are for batch jobs,
    give ``spark``, ``state_partitions`` and ``raw`` as a function that reads the
    stream in the session it gets."""
    root = checkpoint_root.rstrip("/")
    if callable(raw):
        if spark is None:
            raise ValueError("a function that reads the stream needs a session")
        timed = raw(speed_session(spark, state_partitions) if state_partitions else spark)
        raw = raw(spark)
    elif state_partitions:
        raise ValueError("state partitions are those of the session the stream is read in: give a function that reads it")
    else:
        timed = raw
    metrics = start_metrics(timed, speed_table, f"{root}/metrics", trigger)
    alerts = start_alerts(raw, alerts_table, f"{root}/alerts", trigger, buckets=buckets)
    return metrics, alerts
