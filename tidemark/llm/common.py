"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A round over so few links runs in this many partitions.
SMALL_LINKS = 200_000
#: Rows that a Python task takes from an Arrow batch at once.
SLICE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(c: Column) -> Column:
    """A-Z to a-z, every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read
    it back: later jobs neither recompute it nor depend on an executor's disk."""
    spark = df.sparkSession
    if not spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.getCheckpointDir():
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches' rows, so many at once: what a task makes of long texts (words,
    numbers, tokens) never stands beside that of a whole batch. A Python worker keeps
    the memory of its largest moment, whatever it does next."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def pieces_of(total: int, each: int) -> int:
    """How many parts of at most ``each`` hold ``total``."""
    return max(1, -(-int(total) // each))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable over the undirected ``edges``.

    Alternating large-star and small-star rounds. Only aggregates and equi-joins
    with the per-node minimum are used, so a hub's links spread over tasks (the
    partial minimum runs before the shuffle, and the adaptive skew join splits a
    hub's side; it can do so as the minima are a table by then, not an aggregate
    below the join). Nodes without a link are not in the result.
    """
    def minima(of: DataFrame) -> DataFrame:
        return of if n <= SMALL_LINKS else staged(of, "minima")

    links = staged(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                   .where("u < v").distinct(), "links")
    before = None
    while True:
        n, mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == (n, mark):
            break
        before = (n, mark)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = minima(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        if n > SMALL_LINKS:
            large = staged(large, "links")
        # small star: every node's smaller neighbours and itself point at the smallest of them
        low = minima(large.groupBy("v").agg(F.min("u").alias("m")))
        small = large.join(low, "v")
        links = small.select(F.col("m").alias("u"), F.col("u").alias("v")).where("u < v") \
            .unionByName(low.select(F.col("m").alias("u"), "v")).distinct()
        if n <= SMALL_LINKS:
            links = links.coalesce(4)
        links = staged(links, "links")
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")) \
        .unionByName(links.select(F.col("u").alias("node"), F.col("u").alias("root"))) \
        .groupBy("node").agg(F.min("root").alias("root"))
