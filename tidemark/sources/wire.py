"""Decoding of message values, with skip-and-count of undecodable ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import TWEET, TWEET_AVRO

# Registry wire format: 1 magic byte (0) + 4-byte schema id, then the Avro body.
WIRE_HEADER_BYTES = 5
WIRE_MAGIC = "00"


def frame(value: Column, schema_ids: list[int] | None = None) -> tuple[Column, Column, Column]:
    """(schema id, body, bad) of a registry-framed value. Bad: NULL, shorter
    than the header, another first byte than 0, or a schema id that is not among
    ``schema_ids``. Pure Column expressions; id and body are NULL if bad."""
    short = F.coalesce(F.octet_length(value) < WIRE_HEADER_BYTES, F.lit(True))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    bad = short | (F.hex(F.substring(value, 1, 1)) != WIRE_MAGIC)
    if schema_ids is not None:
        bad = bad | ~schema_id.isin(*schema_ids)
    body = F.substring(value, WIRE_HEADER_BYTES + 1, 2**31 - 1)
    return F.when(~bad, schema_id), F.when(~bad, body), bad


def _others(df: DataFrame, value: str, schema: StructType) -> list[Column]:
    """The columns that come with the value (the topic position, for one): kept."""
    return [F.col(c) for c in df.columns if c != value and c not in schema.names]


def _bad(decoded: Column, schema: StructType, value: Column) -> Column:
    # every field is required on the wire: a missing one means a bad message
    missing = [decoded[f.name].isNull() for f in schema.fields]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return value.isNull() | decoded.isNull() | any_missing


def decode_json(df: DataFrame, value: str = "value", schema: StructType = TWEET) -> DataFrame:
    """JSON message values → typed columns + ``is_bad`` (junk, NULL, missing
    field) + the other columns of ``df``, such as ``partition`` and ``offset``.
    Stand-in codec for environments without the Avro package."""
    full = StructType(schema.fields + [StructField("_corrupt", StringType(), True)])
    d = F.from_json(F.col(value).cast("string"), full,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.withColumn("_d", d)
    bad = _bad(F.col("_d"), schema, F.col(value)) | F.col("_d._corrupt").isNotNull()
    return out.select(*[F.col("_d")[f.name].alias(f.name) for f in schema.fields],
                      F.coalesce(bad, F.lit(True)).alias("is_bad"), *_others(df, value, schema))


def decode_wire(df: DataFrame, avro_json: str = TWEET_AVRO, value: str = "value",
                schema: StructType = TWEET, schema_ids: list[int] | None = None) -> DataFrame:
    """Registry-framed Avro values → typed columns + ``is_bad`` + the other
    columns of ``df``. A value with a bad frame is not decoded.
    Needs the spark-avro package on the classpath."""
    from pyspark.sql.avro.functions import from_avro
    _, body, no_frame = frame(F.col(value), schema_ids)
    out = df.withColumn("_d", from_avro(body, avro_json, {"mode": "PERMISSIVE"}))
    bad = no_frame | _bad(F.col("_d"), schema, F.col(value))
    return out.select(*[F.col("_d")[f.name].alias(f.name) for f in schema.fields],
                      F.coalesce(bad, F.lit(True)).alias("is_bad"), *_others(df, value, schema))


def encode_json(df: DataFrame, schema: StructType = TWEET) -> DataFrame:
    return df.select(F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("value"))


def observe_ingest(df: DataFrame, name: str = "ingest", flag: str = "is_bad") -> DataFrame:
    """Attach saved/skipped counters (read back from ``query.lastProgress``
    or an ``Observation``) without a second pass over the data."""
    return df.observe(name, F.count_if(~F.col(flag)).alias("saved"), F.count_if(F.col(flag)).alias("skipped"))


def skip_bad(df: DataFrame, flag: str = "is_bad") -> DataFrame:
    """Drop undecodable messages (they are counted by ``observe_ingest``)."""
    return df.filter(~F.col(flag)).drop(flag)
