"""Keyed tumbling-window metrics (batch and speed layers).

Everything here is built from algebraic Column aggregates (count, count_if,
sum, max, min), so Spark plans a partial HashAggregate before the shuffle on
(window, key) and a final one after it: a hot key is collapsed to one row per
input partition before any data moves, whatever its share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import iso_instant, parse_time, to_ntz
from ..schemas import METRIC_FIELDS, SENTIMENTS

LAYERS = ("batch", "speed")


@dataclass(frozen=True)
class MetricSpec:
    """Names of the input columns and of the produced metric columns.

    The defaults are the tweet data model; any table with a key, a category,
    a numeric measure and a time column can be described the same way.
    """
    key: str = "airline"
    category: str = "airline_sentiment"
    classes: tuple = tuple(SENTIMENTS)                 # counted classes, in output order
    ratio_classes: tuple = ("positive", "negative")    # classes that also get a ratio
    measure: str = "retweet_count"
    count_name: str = "tweet_count"
    class_suffix: str = "_count"
    ratio_suffix: str = "_ratio"
    avg_name: str = "avg_retweet"
    max_name: str = "max_retweet"
    rate_name: str = "tweet_rate"
    rate_divisor: float = 60.0                         # count / 60 for every width (sic)
    key_alias: str | None = None                       # output name of the key column

    def class_col(self, c: str) -> str:
        return f"{c}{self.class_suffix}"

    def ratio_col(self, c: str) -> str:
        return f"{c}{self.ratio_suffix}"

    @property
    def key_out(self) -> str:
        return self.key_alias or self.key

    def output_columns(self) -> list[str]:
        return ([self.key_out, self.count_name] + [self.class_col(c) for c in self.classes]
                + [self.ratio_col(c) for c in self.ratio_classes]
                + [self.avg_name, self.max_name, self.rate_name, "window_start", "window_end"])


TWEET_SPEC = MetricSpec()

# Second preset: orders per priority and day, classes = order status.
ORDERS_SPEC = MetricSpec(key="o_orderpriority", category="o_orderstatus", classes=("F", "O", "P"),
                         ratio_classes=("F", "O"), measure="o_totalprice", count_name="order_count",
                         avg_name="avg_totalprice", max_name="max_totalprice", rate_name="order_rate")

assert TWEET_SPEC.output_columns() == METRIC_FIELDS


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _finish(agg: DataFrame, spec: MetricSpec, avg_expr: Column, max_expr: Column) -> DataFrame:
    n = F.col(spec.count_name)
    cols = [F.col(spec.key).alias(spec.key_out), n]
    cols += [F.col(spec.class_col(c)) for c in spec.classes]
    cols += [_ratio(F.col(spec.class_col(c)), n).alias(spec.ratio_col(c)) for c in spec.ratio_classes]
    cols += [avg_expr.alias(spec.avg_name), max_expr.alias(spec.max_name),
             (n / F.lit(spec.rate_divisor)).alias(spec.rate_name),
             to_ntz(F.col("window.start")).alias("window_start"),
             to_ntz(F.col("window.end")).alias("window_end")]
    return agg.select(*cols)


def windowed_metrics(df: DataFrame, ts: Column | str, width: str = "1 hour", layer: str = "batch",
                     spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Group rows by (tumbling window of ``width`` over ``ts``, key) and compute
    count, per-class counts, ratios, average, maximum and rate.

    ``layer`` picks the null rules:

    * ``batch`` — avg ignores NULL measures, max is a plain max;
    * ``speed`` — avg divides the sum (NULL as 0) by all rows, max starts at 0.

    Rows whose ``ts`` is NULL are dropped (valid-time filter). Works on batch
    and streaming DataFrames; for a stream, ``ts`` must be the watermarked
    TIMESTAMP column.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    t = F.col(ts) if isinstance(ts, str) else ts
    m = F.col(spec.measure)
    cat = F.col(spec.category)
    aggs = [F.count(F.lit(1)).alias(spec.count_name)]
    aggs += [F.count_if(cat == F.lit(c)).alias(spec.class_col(c)) for c in spec.classes]
    if layer == "batch":
        aggs += [F.avg(m).alias("_avg"), F.max(m).alias("_max")]
    else:
        aggs += [F.sum(F.coalesce(m, F.lit(0))).alias("_sum"), F.max(m).alias("_max")]
    # bind the (possibly parsed) time once: filter and window then read a column
    timed = df if isinstance(ts, str) else df.withColumn("_t", t)
    tcol = F.col(ts) if isinstance(ts, str) else F.col("_t")
    agg = (timed.filter(tcol.isNotNull())
                .groupBy(F.window(tcol, width).alias("window"), F.col(spec.key))
                .agg(*aggs))
    max_type = "bigint" if spec.measure == TWEET_SPEC.measure else None
    mx = F.col("_max")
    if layer == "speed":
        mx = F.greatest(F.lit(0), mx)        # coerced to the measure's type
        avg = F.col("_sum") / F.col(spec.count_name)
    else:
        avg = F.col("_avg")
    if max_type:
        mx = mx.cast(max_type)
    return _finish(agg, spec, avg.cast("double"), mx)


def tweet_metrics(tweets: DataFrame, width: str, layer: str, time_mode: str | None = None,
                  time_col: str = "tweet_created") -> DataFrame:
    """Metrics of TWEET rows. The batch layer reads the wall clock and the
    speed layer the instant, unless ``time_mode`` says otherwise."""
    mode = time_mode or ("wall" if layer == "batch" else "instant")
    return windowed_metrics(tweets, parse_time(time_col, mode), width, layer, TWEET_SPEC)


def batch_metrics(tweets: DataFrame, time_mode: str = "wall") -> DataFrame:
    """Batch layer: 1-hour windows, batch null rules."""
    return tweet_metrics(tweets, "1 hour", "batch", time_mode)


def speed_metrics(tweets: DataFrame, time_mode: str = "instant") -> DataFrame:
    """Speed layer (batch form): 1-minute windows, speed null rules."""
    return tweet_metrics(tweets, "1 minute", "speed", time_mode)


def merge_metrics(metrics: DataFrame, width: str = "1 hour", spec: MetricSpec = TWEET_SPEC,
                  integral_measure: bool = True) -> DataFrame:
    """Roll finished speed-layer metrics up to a coarser window.

    Counts add, maxima take the max, ratios and rate are recomputed, and the
    average is rebuilt from Σ(avg·count)/Σcount. With an integral measure the
    per-window sums are restored exactly (rounded), so minute→hour equals the
    hour computed directly.
    """
    n = F.col(spec.count_name)
    s = F.col(spec.avg_name) * n
    if integral_measure:
        s = F.round(s).cast("bigint")
    aggs = [F.sum(n).alias(spec.count_name)]
    aggs += [F.sum(spec.class_col(c)).alias(spec.class_col(c)) for c in spec.classes]
    aggs += [F.sum(s).alias("_sum"), F.max(spec.max_name).alias("_max")]
    agg = (metrics.groupBy(F.window(F.col("window_start"), width).alias("window"), F.col(spec.key_out))
                  .agg(*aggs))
    if spec.key_out != spec.key:
        agg = agg.withColumnRenamed(spec.key_out, spec.key)
    return _finish(agg, spec, (F.col("_sum") / F.col(spec.count_name)).cast("double"), F.col("_max"))


def to_wire(metrics: DataFrame) -> DataFrame:
    """Table-shaped metrics → wire shape (window bounds as ISO instant text)."""
    cols = [F.col(c) for c in metrics.columns if c not in ("window_start", "window_end")]
    return metrics.select(*cols, iso_instant(F.col("window_start").cast("timestamp")).alias("window_start"),
                          iso_instant(F.col("window_end").cast("timestamp")).alias("window_end"))


def with_month(metrics: DataFrame) -> DataFrame:
    """Add the monthly routing column used to partition the batch table."""
    return metrics.withColumn("window_month", F.date_format("window_start", "yyyy-MM"))


# --------------------------------------------------------------------------- mergeable partials
PARTIAL_KEYS = ("window_start", "window_end", "window_month")


def partial_metrics(df: DataFrame, ts: Column | str, width: str = "1 hour", spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Mergeable per-(window, key) state: counts, Σmeasure, non-NULL count and
    max of the measure. Folding new partials into old ones (``combine_partials``)
    and then ``finish_partials`` gives exactly the batch-layer metrics of all
    rows seen, so a growing lake only needs its new files aggregated."""
    t = F.col(ts) if isinstance(ts, str) else ts
    timed = df.withColumn("_t", t).filter(F.col("_t").isNotNull())
    m = F.col(spec.measure)
    aggs = [F.count(F.lit(1)).alias(spec.count_name)]
    aggs += [F.count_if(F.col(spec.category) == F.lit(c)).alias(spec.class_col(c)) for c in spec.classes]
    aggs += [F.sum(m).alias("_sum"), F.count(m).alias("_n"), F.max(m).alias("_max")]
    out = timed.groupBy(F.window("_t", width).alias("window"), F.col(spec.key)).agg(*aggs)
    out = out.select(F.col(spec.key), *[F.col(c) for c in out.columns if c not in ("window", spec.key)],
                     to_ntz(F.col("window.start")).alias("window_start"),
                     to_ntz(F.col("window.end")).alias("window_end"))
    return with_month(out)


def combine_partials(partials: DataFrame, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Merge partial rows of the same (window, key): sums add, max of max."""
    sums = [spec.count_name] + [spec.class_col(c) for c in spec.classes] + ["_sum", "_n"]
    aggs = [F.sum(c).alias(c) for c in sums] + [F.max("_max").alias("_max")]
    return partials.groupBy(spec.key, *PARTIAL_KEYS).agg(*aggs)


def finish_partials(partials: DataFrame, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Partials → batch-layer metrics (avg over non-NULL measures, plain max)."""
    n = F.col(spec.count_name)
    avg = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).cast("double")
    mx = F.col("_max").cast("bigint") if spec.measure == TWEET_SPEC.measure else F.col("_max")
    cols = [F.col(spec.key).alias(spec.key_out), n]
    cols += [F.col(spec.class_col(c)) for c in spec.classes]
    cols += [_ratio(F.col(spec.class_col(c)), n).alias(spec.ratio_col(c)) for c in spec.ratio_classes]
    cols += [avg.alias(spec.avg_name), mx.alias(spec.max_name), (n / F.lit(spec.rate_divisor)).alias(spec.rate_name),
             F.col("window_start"), F.col("window_end")]
    return partials.select(*cols)


# --------------------------------------------------------------------------- both clocks in one pass
WALL_MINUTE, INSTANT_MINUTE = "_wall", "_instant"


def two_clock_partials(tweets: DataFrame, time_col: str = "tweet_created", spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Mergeable partials for each (key, minute on the wall clock, minute of the
    instant): one pass over the rows serves windows of whole minutes on either clock.
    A row whose time parses on one clock only has NULL on the other. As rows differ
    from the instant by their offset alone, there are hardly more partials than
    minutes and keys."""
    t = tweets.withColumn(WALL_MINUTE, F.date_trunc("minute", parse_time(time_col, "wall"))) \
        .withColumn(INSTANT_MINUTE, F.date_trunc("minute", parse_time(time_col, "instant"))) \
        .filter(F.col(WALL_MINUTE).isNotNull() | F.col(INSTANT_MINUTE).isNotNull())
    m = F.col(spec.measure)
    aggs = [F.count(F.lit(1)).alias(spec.count_name)]
    aggs += [F.count_if(F.col(spec.category) == F.lit(c)).alias(spec.class_col(c)) for c in spec.classes]
    aggs += [F.sum(m).alias("_sum"), F.count(m).alias("_n"), F.max(m).alias("_max")]
    return t.groupBy(spec.key, WALL_MINUTE, INSTANT_MINUTE).agg(*aggs)


def from_two_clocks(partials: DataFrame, width: str, layer: str, time_mode: str, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Metrics of windows of ``width`` on one clock, with a layer's null rules."""
    minute = F.col({"wall": WALL_MINUTE, "instant": INSTANT_MINUTE}[time_mode])
    sums = [spec.count_name, *[spec.class_col(c) for c in spec.classes], "_sum", "_n"]
    merged = partials.filter(minute.isNotNull()).groupBy(F.window(minute, width).alias("window"), F.col(spec.key)) \
        .agg(*[F.sum(c).alias(c) for c in sums], F.max("_max").alias("_max"))
    rows = merged.select("*", to_ntz(F.col("window.start")).alias("window_start"), to_ntz(F.col("window.end")).alias("window_end"))
    return finish_partials(rows, spec) if layer == "batch" else speed_of_sums(rows, spec)


def speed_of_sums(rows: DataFrame, spec: MetricSpec = TWEET_SPEC) -> DataFrame:
    """Counts, sum and maximum of windows → speed-layer metrics (NULL measures are 0)."""
    n = F.col(spec.count_name)
    mx = F.greatest(F.lit(0), F.col("_max"))
    if spec.measure == TWEET_SPEC.measure:
        mx = mx.cast("bigint")
    cols = [F.col(spec.key).alias(spec.key_out), n, *[F.col(spec.class_col(c)) for c in spec.classes]]
    cols += [_ratio(F.col(spec.class_col(c)), n).alias(spec.ratio_col(c)) for c in spec.ratio_classes]
    cols += [(F.coalesce(F.col("_sum"), F.lit(0)) / n).cast("double").alias(spec.avg_name), mx.alias(spec.max_name),
             (n / F.lit(spec.rate_divisor)).alias(spec.rate_name), F.col("window_start"), F.col("window_end")]
    return rows.select(*cols)
