"""Spark session helpers and shared scratch locations.

Scratch data (written tables, stream checkpoints) always lives under the
cluster's shared ``spark.checkpoint.dir``.  Only when that setting is
unset (local tests) do we point it at a fresh directory of our own.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans shuffles at runtime
# (partition coalescing, skew-join splitting), timestamps are UTC.
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "eventide", driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:      # local mode: the driver JVM is the whole cluster; set before it starts
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in SCALE_CONFS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="eventide-code-"), "eventide"), "zip",
                               os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(made)      # Spark serves it to the executors
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no SparkContext (Spark Connect): use the setting only
        sc = None
    cur = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur.rstrip("/")
    if sc and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="eventide-ckpt-")   # only when the cluster names none (tests)
    if sc:
        sc.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # noqa: BLE001 -- core settings may be locked; the context dir suffices
        pass
    return (sc.getCheckpointDir() if sc else None) or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def recommended_confs(total_cores: int, input_bytes: int,
                      target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: partitions of about ``target_partition_bytes``.

    * scan splits of that size (``maxPartitionBytes``), so a task's input fits
      comfortably in executor memory and spills rarely;
    * initial shuffle partitions = max(3 x cores, input / target), which AQE
      then coalesces toward the same advisory size and splits when skewed;
    * the automatic broadcast threshold stays at a fixed 64 MiB -- our own
      broadcasts are additionally guarded by row counts.

    Example: 100 TB on 1000 executors x 8 cores -> about 400,000 shuffle partitions.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
