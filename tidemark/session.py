"""Session construction and the few settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library expects. Time zone is pinned so that the
# "wall" clock of the batch layer and the "instant" clock of the speed layer
# are both expressed in UTC; partition type inference is off so that a
# partition value such as airline "007" stays a string.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalog tables here receive appends into existing partitions (new alert
    # keys, speed micro-batches, lake statistics); the shared per-partition
    # file-listing cache can keep serving the listing from before the append,
    # so it is off. The tables have few partitions (buckets, days, months),
    # so listing them per query is cheap.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


# Suggested settings for a large cluster (merge into the cluster's own
# configuration; nothing here is applied automatically):
# * many initial shuffle partitions, AQE coalesces them to ~256 MB each and
#   splits skewed ones;
# * 256 MB scan splits;
# * RocksDB state for the streaming aggregation (state off-heap, checkpointed
#   incrementally). A stream's state partition count is fixed for the life of
#   its checkpoint: read the speed queries' stream in a ``speed_session`` sized
#   to the source (e.g. twice the topic partitions), not 4000.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own builder settings
    through ``extra`` and let ``spark.checkpoint.dir`` come from the cluster."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive execution for the jobs of this block. The session of a stateful
    query's micro-batches has it off (the state's partitions must not change), and
    without it Spark drops a ``rebalance`` hint. The micro-batch itself is planned
    before its sink is called, so on in the sink it only concerns the sink's own jobs."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only when it is unset (local runs, tests) a
    folder of our own is chosen."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder, for tables and
    stream checkpoints that a job derives and reads back."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared checkpoint folder and read back, with its
    folder; ``discard`` removes that when the rows have reached their table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def file_system(spark: SparkSession, folder: str):
    """The file system of a path, and the path, for small files and folders that jobs leave as notes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    fs, path = file_system(spark, folder)
    return fs.exists(path)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder (atomic where the file system's rename is)."""
    fs, path = file_system(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(path, goal):
        raise OSError(f"could not move {source} to {target}")


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove folders that ``stored`` made."""
    for folder in folders:
        fs, path = file_system(spark, folder)
        fs.delete(path, True)


__all__ = ["build_session", "apply_conf", "adaptive", "ensure_checkpoint_dir", "scratch_path", "stored", "discard", "file_system", "REQUIRED_CONF",
           "CLUSTER_CONF"]


def scratch_database(spark: SparkSession, name: str) -> str:
    """Create a database whose managed tables live in a fresh folder below the
    shared checkpoint folder; returns its name. Managed tables make
    ``DROP TABLE`` / ``DROP PARTITION`` remove data, which publishing,
    pruning and upserts rely on."""
    loc = scratch_path(spark, name)
    db = f"{name}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}'")
    return db


__all__ += ["scratch_database"]
