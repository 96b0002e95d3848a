"""Numbering rows in an order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def prefix_index(df: DataFrame, order: list, by: list[str] = (), out: str = "index") -> DataFrame:
    """Adds ``out``: each row's place 1, 2, ... in ``order`` among the rows that share
    the ``by`` columns (among all rows without them); NULL keys are one group.

    The rows are range-partitioned by (by, order), sorted within partitions and
    stored once, numbered through each partition. A count for each (partition,
    group) gives the offset at which a partition goes on with a group, so a group
    that holds a third of all rows, or all of them, is dealt out over as many tasks
    as its size needs. The table of counts has a row per group and one more for
    each partition a group runs over. Rows that are equal in ``order`` are numbered
    in any order, once and for all; make the order total where that matters."""
    keys: list[Column] = [F.col(c) if isinstance(c, str) else c for c in order]
    own = df.repartitionByRange(*by, *keys).sortWithinPartitions(*by, *keys).withColumn("__at", F.monotonically_increasing_id())
    rows, _ = stored(own, "prefix-index")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    counts = rows.groupBy("__part", *by).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a row per partition
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("*", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")).alias("s")
    rows = rows.alias("r")
    same = F.col("r.__part") == F.col("s.__part")
    for c in by:
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    index = F.col("r.__at") - F.col("s.__first") + F.col("s.__before") + 1
    return rows.join(starts, same).select(*[F.col(f"r.`{c}`") for c in df.columns if c != out], index.alias(out))
