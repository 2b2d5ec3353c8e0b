"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Options every fundlens session wants; a cluster deployment passes its own
# master/memory settings and keeps these.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fundlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins; only in local mode with
    nothing set (unit tests, a laptop) do we create a local folder. On a
    cluster an unset dir is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                               "(checkpoints, written tables and models go there)")
        configured = tempfile.mkdtemp(prefix="fundlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables; ``clear_scratch`` removes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fundlens/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written under ``scratch_path``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a job reading ``input_bytes``.

    Scan splits and shuffle partitions both aim at ``target_partition_bytes``
    so a task's working set fits in executor memory; the shuffle width is at
    least two waves of the cluster's cores, and AQE coalesces it down (or
    splits skewed partitions) at run time.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
