"""What a running or stopped metrics query still holds: its open windows, read from
the checkpoint's state store, and the late rows it has dropped."""

from __future__ import annotations

import threading
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.time import to_ntz
from ..operators.metrics import TWEET_SPEC, MetricSpec, speed_of_sums


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """The metrics, so far, of the windows that a query with this checkpoint has not
    emitted yet, with the speed layer's null rules; those after ``batch_id`` if given
    (as long as the store keeps that version).

    The state data source reads the store's partitions in tasks. The stored values
    are the aggregate's buffers in the order in which ``windowed_metrics`` declares
    them: row count, class counts, sum and maximum of the measure."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    state = r.load(checkpoint)
    max_type = state.schema["value"].dataType.fields[-1].dataType.simpleString()
    sum_type = state.schema["value"].dataType.fields[-2].dataType.simpleString()
    counts = [spec.count_name, *[spec.class_col(c) for c in spec.classes]]
    named = f"struct<{', '.join(f'{c}:bigint' for c in counts)}, _sum:{sum_type}, _max:{max_type}>"
    v = F.col("value").cast(named)       # by position: the buffers' own names repeat
    rows = state.select(F.col("key")[spec.key].alias(spec.key), *[v[c].alias(c) for c in counts], v["_sum"].alias("_sum"), v["_max"].alias("_max"),
                        to_ntz(F.col("key.window.start")).alias("window_start"), to_ntz(F.col("key.window.end")).alias("window_end"))
    return speed_of_sums(rows, spec)


#: Micro-batches whose late rows a ``LateRows`` remembers one by one.
REMEMBERED = 10_000
LATE = "batch bigint, input_rows bigint, watermark string, dropped bigint"


class LateRows(StreamingQueryListener):
    """Rows that came too late, by query and micro-batch, while this is registered with
    ``spark.streams.addListener``: input rows, the watermark in force, and what the
    state store dropped as its window had closed. Spark counts a dropped row after the
    partial aggregation: all late rows of one task in one (window, key) are one.

    The totals cover all micro-batches, ``rows`` the last ``REMEMBERED`` with input."""

    def __init__(self):
        self._batches: dict[str, deque] = {}
        self._totals: dict[str, list[int]] = {}
        self._seen: dict[str, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        with self._lock:
            total = self._totals.setdefault(str(p.id), [0, 0])
            total[0] += p.numInputRows
            total[1] += dropped
            self._seen[str(p.id)] = p.batchId
            if p.numInputRows:
                self._batches.setdefault(str(p.id), deque(maxlen=REMEMBERED)).append(
                    (p.batchId, p.numInputRows, dict(p.eventTime).get("watermark"), dropped))

    def totals(self, query: StreamingQuery) -> tuple[int, int]:
        """(input rows, dropped) of all micro-batches so far."""
        with self._lock:
            return tuple(self._totals.get(str(query.id), (0, 0)))

    def wait(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Until the events of a stopped query's last micro-batch have arrived."""
        last, end = query.lastProgress, time.time() + seconds
        while last and self._seen.get(str(query.id), -1) < last["batchId"] and time.time() < end:
            time.sleep(0.05)

    def rows(self, spark: SparkSession, query: StreamingQuery) -> DataFrame:
        with self._lock:
            found = list(self._batches.get(str(query.id), ()))
        return spark.createDataFrame(found, LATE)
