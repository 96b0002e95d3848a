"""Adapters from the shared test tables to the tweet data model.

``events`` (event_id, ts, user_id, event_type, value, props) stands in for the
tweet stream. The mapping is a fixed convention of the test suite:

* tweet_id          = event_id as text
* airline           = 'airline_' || (user_id % 6)
* airline_sentiment = error → negative, purchase → positive, else neutral
* text              = props
* retweet_count     = floor(value) as INT
* tweet_created     = ts formatted as ``yyyy-MM-dd HH:mm:ss`` + ' -0800'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: adapter convention ---------------------------------------
AIRLINE_BUCKETS = 6
AIRLINE_PREFIX = "airline_"
EVENT_SENTIMENT = {"error": "negative", "purchase": "positive"}
DEFAULT_SENTIMENT = "neutral"
ZONE_SUFFIX = " -0800"
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sentiment(event_type):
    expr = F.lit(DEFAULT_SENTIMENT)
    for ev, s in reversed(list(EVENT_SENTIMENT.items())):
        expr = F.when(event_type == F.lit(ev), F.lit(s)).otherwise(expr)
    return expr


def events_as_tweets(events: DataFrame, keep=()) -> DataFrame:
    """events → TWEET columns (plus any ``keep`` source columns)."""
    return events.select(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.concat(F.lit(AIRLINE_PREFIX), (F.col("user_id") % AIRLINE_BUCKETS).cast("string")).alias("airline"),
        _sentiment(F.col("event_type")).alias("airline_sentiment"),
        F.col("props").alias("text"),
        F.floor("value").cast("int").alias("retweet_count"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(ZONE_SUFFIX)).alias("tweet_created"),
        *[F.col(k) for k in keep],
    )


def events_as_landing(events: DataFrame) -> DataFrame:
    """events → all-text landing rows, as a headered CSV would give them."""
    t = events_as_tweets(events)
    return t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])


def tweets(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return events_as_tweets(table(spark, sf_dir, "events"), keep)


def events_as_alert_updates(events: DataFrame) -> DataFrame:
    """Alert updates keyed so that keys repeat: tweet_id = user_id, the event
    id orders arrivals (highest wins), created_at = event time."""
    t = events_as_tweets(events, keep=("event_id", "user_id", "ts"))
    return t.select(
        F.col("user_id").cast("string").alias("tweet_id"),
        "airline", "airline_sentiment", "text", "retweet_count", "tweet_created",
        F.col("ts").cast("timestamp").alias("created_at"),
        "event_id",
    )


# ---- fixed values: which event ids carry which fault --------------------------
DIRTY_MODULUS = 23
ODD_VALUES = 25
# ----------------------------------------------------------------------------


def dirty_tweets(events: DataFrame, keep=()) -> DataFrame:
    """events → TWEET columns in which every rule meets rows it must handle, by
    ``event_id % 23``: 0 NULL airline, 1 NULL sentiment, 2 NULL measure, 3 wrong
    case, 4 one of 25 unknown classes, 5 garbage time, 6 another offset, 7 negative
    measure, 8 empty text, 9 NULL time, 10 empty airline, 11 NULL id."""
    m = F.col("event_id") % DIRTY_MODULUS
    odd = F.concat(F.lit("odd_"), (F.floor(F.col("event_id") / DIRTY_MODULUS) % ODD_VALUES).cast("string"))
    t = events_as_tweets(events, keep=("event_id", *keep))
    null = F.lit(None)
    return t.select(
        F.when(m != 11, F.col("tweet_id")).alias("tweet_id"),
        F.when(m == 10, "").when(m != 0, F.col("airline")).alias("airline"),
        F.when(m == 1, null).when(m == 3, "Positive").when(m == 4, odd).otherwise(F.col("airline_sentiment")).alias("airline_sentiment"),
        F.when(m == 8, "").otherwise(F.col("text")).alias("text"),
        F.when(m == 7, -5).when(m != 2, F.col("retweet_count")).cast("int").alias("retweet_count"),
        F.when(m == 5, "garbage").when(m == 6, F.regexp_replace("tweet_created", " -0800$", " +0530"))
         .when(m != 9, F.col("tweet_created")).alias("tweet_created"),
        "event_id", *keep)
