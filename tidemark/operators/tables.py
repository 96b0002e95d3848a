"""Small helpers over catalog tables (managed Parquet tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import discard, stored


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


# Stored with every partitioned table of the library: an overwrite then only
# replaces the partitions present in the written rows. Being a table option,
# it needs no session setting (safe with concurrent jobs in one session).
DYNAMIC_OVERWRITE = {"partitionOverwriteMode": "dynamic"}


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` holds rows for.

    ``table`` must carry ``DYNAMIC_OVERWRITE`` (all tables created here do);
    ``df`` must not read ``table`` itself (cut its lineage first, e.g. with
    ``checkpoint()``); columns are matched to the table by name."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    df.select(*cols).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)


#: Table property: the folder of rows that an unfinished overwrite still has to bring in.
PENDING = "tidemark.overwrite.pending"


def overwrite_safely(df: DataFrame, table: str) -> None:
    """``overwrite_partitions`` that survives a crash at any point, from rows that
    may be read from ``table`` itself.

    The rows are stored in a folder first and the table's properties name it;
    only then the partitions are replaced, and the note is taken back. If the
    job dies in between, ``finish_overwrite`` replaces the partitions again from
    that folder: partitions that were already replaced get the same rows."""
    spark = df.sparkSession
    _, folder = stored(df, "overwrite")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}' = '{folder}')")
    finish_overwrite(spark, table)


def finish_overwrite(spark: SparkSession, table: str) -> bool:
    """Complete an overwrite that was cut off; returns whether there was one."""
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    folder = props.get(PENDING)
    if not folder:
        return False
    overwrite_partitions(spark.read.parquet(folder), table)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    discard(spark, folder)
    return True


def append_rows(df: DataFrame, table: str) -> None:
    """Append ``df`` to ``table`` (columns matched by name), then drop the
    session's cached file listing of the table so the next read sees the
    new files."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    df.select(*cols).write.mode("append").insertInto(table)
    spark.catalog.refreshTable(table)


def partition_values(spark: SparkSession, table: str) -> list[dict]:
    """Partition specs of a table (catalog metadata: one entry per partition,
    bounded by the partitioning, not by the rows)."""
    out = []
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = {}
        for part in r[0].split("/"):
            k, _, v = part.partition("=")
            spec[k] = v
        out.append(spec)
    return out


def drop_partitions(spark: SparkSession, table: str, specs: list[dict]) -> None:
    if not specs:
        return
    parts = ", ".join("PARTITION (" + ", ".join(f"{k} = null" if v is None else f"{k} = '{v}'" for k, v in s.items()) + ")" for s in specs)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")
