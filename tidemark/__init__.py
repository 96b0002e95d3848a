"""Lambda-style event analytics on Spark DataFrames.

The operators most users need, importable from the package root::

    from tidemark import build_session, batch_metrics, speed_stream, unified, upsert
"""

from .functions import int_or_zero, iso_instant, parse_instant, parse_wall
from .operators.alerts import (alert_filter, alerts_airline_sentiment, alerts_by_airline, alerts_latest,
                               alerts_recent, compact_buckets, upsert)
from .operators.metrics import (ORDERS_SPEC, TWEET_SPEC, MetricSpec, batch_metrics, merge_metrics, speed_metrics,
                                to_wire, windowed_metrics)
from .operators.quality import QualityError, check_alerts, check_lake, check_metrics, run_checks, summary
from .operators.serving import (archive, create_unified_view, metrics_for_airline, prune_speed, publish_version,
                                time_range, unified)
from .plans.batch_cycle import CycleConfig, run_batch_cycle
from .session import apply_conf, build_session
from .sources.landing import landing_records, normalise, ordered, read_landing
from .sources.lake import append_raw, file_stream, read_raw, write_raw
from .sources.wire import decode_json, decode_wire, observe_ingest, skip_bad
from .streaming.speed import (speed_stream, start_alerts, start_metrics, start_metrics_wire, start_speed_layer,
                              with_event_time)

__all__ = [n for n in dir() if not n.startswith("_")]
