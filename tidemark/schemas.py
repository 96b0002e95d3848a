"""Fixed schemas of the tweet-analytics data model.

The field names, order and types below are fixed values: they must equal the
wire, lake and table layouts of the system this library re-implements, so
that its files and messages can be read and written unchanged.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

# ---- fixed values: field layouts -------------------------------------------
TWEET_FIELDS = ["tweet_id", "airline", "airline_sentiment", "text", "retweet_count", "tweet_created"]
RAW_LAKE_FIELDS = TWEET_FIELDS + ["ingested_at"]
METRIC_FIELDS = ["airline", "tweet_count", "positive_count", "negative_count", "neutral_count",
                 "positive_ratio", "negative_ratio", "avg_retweet", "max_retweet", "tweet_rate",
                 "window_start", "window_end"]
SENTIMENTS = ["positive", "negative", "neutral"]
ALERT_SENTIMENT = "negative"
SOURCE_BATCH = "BATCH"
SOURCE_SPEED = "REAL-TIME"
# ----------------------------------------------------------------------------

TWEET = StructType([
    StructField("tweet_id", StringType(), True),
    StructField("airline", StringType(), True),
    StructField("airline_sentiment", StringType(), True),
    StructField("text", StringType(), True),
    StructField("retweet_count", IntegerType(), True),
    StructField("tweet_created", StringType(), True),
])

RAW_LAKE = StructType([
    StructField("tweet_id", StringType(), True),
    StructField("airline", StringType(), True),
    StructField("airline_sentiment", StringType(), True),
    StructField("text", StringType(), True),
    StructField("retweet_count", LongType(), True),
    StructField("tweet_created", StringType(), True),
    StructField("ingested_at", StringType(), True),
])

LANDING = StructType([StructField(c, StringType(), True) for c in TWEET_FIELDS])

_METRIC_VALUES = [
    StructField("airline", StringType(), True),
    StructField("tweet_count", LongType(), True),
    StructField("positive_count", LongType(), True),
    StructField("negative_count", LongType(), True),
    StructField("neutral_count", LongType(), True),
    StructField("positive_ratio", DoubleType(), True),
    StructField("negative_ratio", DoubleType(), True),
    StructField("avg_retweet", DoubleType(), True),
    StructField("max_retweet", LongType(), True),
    StructField("tweet_rate", DoubleType(), True),
]

METRICS_WIRE = StructType(_METRIC_VALUES + [
    StructField("window_start", StringType(), True),
    StructField("window_end", StringType(), True),
])

METRICS_TABLE = StructType(_METRIC_VALUES + [
    StructField("window_start", TimestampNTZType(), True),
    StructField("window_end", TimestampNTZType(), True),
])

UNIFIED = StructType(METRICS_TABLE.fields + [StructField("source", StringType(), True)])

ALERT = StructType(TWEET.fields + [StructField("created_at", TimestampType(), True)])

DQ_REPORT = StructType([
    StructField("layer", StringType(), False),
    StructField("check", StringType(), False),
    StructField("passed", BooleanType(), False),
    StructField("detail", StringType(), True),
])

# ---- fixed values: Avro record schemas of the wire format -------------------
# Field names, order and types must match the producers'; the record
# namespace is ours (decoding uses this schema as the writer's schema).
TWEET_AVRO = """{"type":"record","name":"Tweet","namespace":"tidemark","fields":[
{"name":"tweet_id","type":"string"},
{"name":"airline","type":"string"},
{"name":"airline_sentiment","type":"string"},
{"name":"text","type":"string"},
{"name":"retweet_count","type":"int"},
{"name":"tweet_created","type":"string"}]}"""

METRICS_AVRO = """{"type":"record","name":"TweetMetrics","namespace":"tidemark","fields":[
{"name":"airline","type":"string"},
{"name":"tweet_count","type":"long"},
{"name":"positive_count","type":"long"},
{"name":"negative_count","type":"long"},
{"name":"neutral_count","type":"long"},
{"name":"positive_ratio","type":"double"},
{"name":"negative_ratio","type":"double"},
{"name":"avg_retweet","type":"double"},
{"name":"max_retweet","type":"long"},
{"name":"tweet_rate","type":"double"},
{"name":"window_start","type":"string"},
{"name":"window_end","type":"string"}]}"""
# ----------------------------------------------------------------------------
