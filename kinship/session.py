"""Session construction and shared-folder helpers.

Everything here is ordinary SparkSession configuration. The settings that
matter at scale are the adaptive-execution ones: runtime coalescing of
shuffle partitions, runtime conversion of sort-merge joins into broadcast
joins when a materialised side turns out small, and skew-join splitting for
accounts that receive a large share of all follows or visits.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Size checks before Spark broadcasts a join side by itself. The static limit
# applies to Catalyst's estimate (derived from compressed file sizes, so it
# can undershoot the in-memory size) and stays at Spark's conservative 10 MiB;
# the adaptive limit applies to the measured output of a finished shuffle
# stage and may be larger. Sides above the limits are joined with a shuffle.
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024
ADAPTIVE_BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

# Shuffle width of a local master.
LOCAL_PARTITIONS = 8


def session_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Session settings; the shuffle width only where one is given."""
    width = {} if shuffle_partitions is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions)}
    return width | {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(ADAPTIVE_BROADCAST_LIMIT_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    * input splits of ``target_partition_bytes`` (256 MiB by default), so a
      100 TB scan is ~400k tasks, a few waves on a 1000-executor cluster;
    * an initial shuffle width that gives each reducer about that much data
      before partial aggregation, never fewer than two tasks per core; AQE
      then coalesces small partitions toward the advisory size and splits
      skewed ones.
    """
    mib = 1024 * 1024
    partitions = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mib),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * mib),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mib),
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of files below ``paths`` (which may be patterns), on whatever file system they name."""
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(hadoop_conf)
        found = fs.globStatus(path)
        if not found:
            raise FileNotFoundError(p)
        total += sum(fs.getContentSummary(status.getPath()).getLength() for status in found)
    return int(total)


def apply_scale_conf(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Size splits and shuffles for the inputs at ``paths`` on this cluster."""
    conf = scale_conf(input_bytes(spark, paths), spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "kinship",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the engine's settings.

    On a cluster pass ``master=None`` and let spark-submit decide, also on
    the shuffle width: it is set only when given, or for a local master
    (LOCAL_PARTITIONS). A checkpoint folder is only invented for a local
    master; see :func:`shared_dir`.
    """
    builder = SparkSession.builder.appName(app_name)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = LOCAL_PARTITIONS
    conf = session_conf(shuffle_partitions)
    if master:
        builder = builder.master(master)
        conf["spark.driver.memory"] = os.environ.get("KINSHIP_DRIVER_MEMORY", "6g")
        if master.startswith("local"):
            # Split small inputs into about three tasks per core so one
            # straggling split does not idle the others. Large inputs are
            # still cut at spark.sql.files.maxPartitionBytes.
            conf["spark.sql.files.minPartitionNum"] = str(3 * _local_cores(master))
    for key, value in {**conf, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _local_cores(master: str) -> int:
    inside = master[master.find("[") + 1 : master.find("]")] if "[" in master else "1"
    if inside in ("*", ""):
        return os.cpu_count() or 1
    return int(inside.split(",")[0])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is named, a fresh folder is made for a local master, whose
    executors are the driver; on a cluster that is an error, as executors do
    not see the driver's folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set, and {master} needs a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kinship-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
