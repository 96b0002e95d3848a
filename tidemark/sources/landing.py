"""Landing-zone CSV: read, normalise, order by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_instant
from ..functions.values import int_or_zero
from ..schemas import TWEET_FIELDS

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
#: Input position of a row: file, place of the split in it, row order within the split.
POSITION = "_position"


def read_landing(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = True,
                 position: bool = False) -> DataFrame:
    """Headered CSV → the six tweet columns, all text, bound **by name**.

    Quoted fields may hold commas, doubled quotes and newlines; undecodable
    bytes are replaced, not fatal. Empty fields are empty text, quoted or not.
    Extra columns are ignored; a missing one is an error. No schema is passed
    on purpose: an explicit schema binds columns by position even when a header
    is present.

    ``multi_line`` reads each file in one task, which newlines inside fields
    need; turn it off for files known to have none, and they are split.
    ``position`` adds the row's input position, an ordering key."""
    raw = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower()).option("encoding", encoding).csv(path)
    missing = [c for c in TWEET_FIELDS if c not in raw.columns]
    if missing:
        raise ValueError(f"landing file lacks columns {missing}")
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in TWEET_FIELDS]
    if position:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("row")).alias(POSITION))
    return raw.select(*cols)


def write_landing(df: DataFrame, path: str) -> None:
    """Write text rows as headered, RFC-4180-quoted CSV (quotes doubled)."""
    (df.select(*[F.col(c).cast("string") for c in TWEET_FIELDS])
       .write.mode("errorifexists").option("header", "true").option("quote", '"').option("escape", '"')
       .option("quoteAll", "true").csv(path))


def normalise(df: DataFrame) -> DataFrame:
    """All-text landing rows → TWEET columns + ``is_bad`` (and the position, if read).

    ``retweet_count``: empty or NULL → 0, blanks trimmed, anything else that
    is no integer → NULL with ``is_bad`` set.
    """
    rt, bad = int_or_zero(F.col("retweet_count"))
    return df.select("tweet_id", "airline", "airline_sentiment", "text", rt.alias("retweet_count"),
                     "tweet_created", bad.alias("is_bad"), *[c for c in df.columns if c == POSITION])


def landing_counts(df: DataFrame) -> DataFrame:
    """One row for normalised rows: ``records`` that a producer publishes and
    ``rejected`` ones whose retweet count is no integer."""
    return df.agg(F.count_if(~F.col("is_bad")).alias("records"), F.count_if("is_bad").alias("rejected"))


def ordered(df: DataFrame, mode: str = "text", seq_col: str | None = None) -> DataFrame:
    """Chronological order for replay.

    ``text`` sorts on the ``tweet_created`` string (right in time only when
    every row carries the same offset); ``instant`` sorts on the parsed UTC
    instant, unparseable rows last. Ties keep input order through ``seq_col``,
    or the position that ``read_landing(position=True)`` gave; for rows without
    either, the order in which Spark reads them. A global sort is a
    range-partitioned shuffle: it scales with the data.
    """
    own = seq_col or (POSITION if POSITION in df.columns else None)
    d = df if own else df.withColumn("_seq", F.monotonically_increasing_id())
    seq = own or "_seq"
    if mode == "text":
        d = d.orderBy(F.col("tweet_created").asc_nulls_first(), F.col(seq))
    elif mode == "instant":
        d = d.orderBy(parse_instant("tweet_created").asc_nulls_last(), F.col(seq))
    else:
        raise ValueError("mode must be 'text' or 'instant'")
    return d if seq_col else d.drop(seq)


def landing_records(spark: SparkSession, path: str, mode: str = "text", multi_line: bool = True) -> DataFrame:
    """read → normalise → drop bad rows → replay order: the records a
    producer publishes, in publishing order. (``landing_counts`` counts the
    dropped ones; a counter here would see rows twice, as a global sort reads
    its input once more for a sample.)"""
    n = normalise(read_landing(spark, path, multi_line=multi_line, position=True))
    return ordered(n.filter(~F.col("is_bad")).drop("is_bad"), mode)
