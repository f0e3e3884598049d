"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marquee", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the models rely on.

    Only the session time zone matters for results (TIMESTAMP_NTZ values are
    zone-free, but ``date_format`` on the landing is not); the rest are
    throughput settings.  On a cluster, pass ``master=None`` and let the
    launcher decide.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Throughput settings sized from the input, for a real cluster.

    Shuffle partitions start at ~input/target (at least 2x the cores) and
    AQE coalesces them down at run time; the skew-join split threshold is
    set to the target so one hot key's partition is split into
    target-sized pieces.  Broadcasts stay with AQE's runtime sizes: the
    static threshold is kept at its default.
    """
    cores = executors * cores_per_executor
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.parquet.filterPushdown": "true",
    }


def workspace_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset
    and driver and executors share one machine (a ``local[*]`` master) one is
    created under the system temp folder and registered, so that
    ``DataFrame.checkpoint()`` uses the same place; any other master raises.
    The folder itself is made by whoever writes to it, through Spark.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors "
                               f"share: {sc.master} has none of its own")
        base = tempfile.mkdtemp(prefix="marquee-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/") + "/" + (name or uuid.uuid4().hex)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
