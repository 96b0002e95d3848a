"""Option builders for external systems. They carry no logic: the operators
of the library take and return DataFrames, and these helpers only wire a
reader or writer to a broker, database or object store. The matching jars
(spark-sql-kafka, spark-avro, a JDBC driver, hadoop-aws) must be on the
cluster's classpath; nothing here can run without them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METRICS_AVRO, TWEET_AVRO


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic stream from the earliest offset: the values, and each record's time,
    partition and offset, which order arrivals; offsets are kept in the query
    checkpoint, not in a consumer group."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select("value", "timestamp", "partition", "offset")


def wire_value(df: DataFrame, avro_json: str, schema_id: int) -> DataFrame:
    """Encode rows as registry-framed Avro: magic byte 0, 4-byte schema id, body."""
    from pyspark.sql.avro.functions import to_avro
    header = F.unhex(F.lit("00" + format(schema_id, "08x")))
    return df.select(F.concat(header, to_avro(F.struct(*df.columns), avro_json)).alias("value"))


def kafka_write_stream(df: DataFrame, servers: str, topic: str, checkpoint: str):
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))


def jdbc_options(url: str, table: str, user: str, password: str, driver: str) -> dict:
    """Reader/writer options for a JDBC table (the driver jar must be on the classpath)."""
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def s3a_conf(endpoint: str, path_style: bool = True, ssl: bool = True) -> dict:
    """Session settings for an S3-compatible store; keys come from the
    standard AWS environment variables through the default provider chain."""
    return {"spark.hadoop.fs.s3a.endpoint": endpoint,
            "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}


TOPICS = {"raw": ("tweets.raw", TWEET_AVRO), "alert": ("tweets.alert", TWEET_AVRO),
          "metrics": ("tweets.metrics", METRICS_AVRO)}


def kafka_write(df: DataFrame, servers: str, topic: str) -> None:
    """Batch publish of a ``value`` column (e.g. from ``wire_value``) to a topic."""
    (df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())


def publish_landing(spark: SparkSession, path: str, servers: str, schema_id: int, topic: str = "tweets.raw") -> dict:
    """Landing CSV → normalised, replay-ordered records → raw topic. Rows whose
    retweet count is no integer are left out; returns how many ``records`` were
    published and how many rows ``rejected``."""
    from .landing import landing_counts, landing_records, normalise, read_landing
    counts = landing_counts(normalise(read_landing(spark, path))).first().asDict()
    kafka_write(wire_value(landing_records(spark, path), TWEET_AVRO, schema_id), servers, topic)
    return counts
