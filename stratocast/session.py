"""Session construction and the shared checkpoint folder.

The settings below are the ones every job in this package relies on:

* UTC session zone, so ``to_date`` on reading timestamps never shifts a day.
* AQE on: partitions are coalesced after each shuffle, skewed join partitions
  are split, and a join side that turns out small at runtime becomes a
  broadcast. The static broadcast threshold stays Spark's size-checked default.
* The UI is off: no port is opened beyond what a session needs.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "stratocast",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the package defaults applied.

    ``master`` is left to the cluster launcher when None. On a cluster, size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle data per
    partition); AQE then coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the launcher to a folder every executor
    can reach; it is read from the session, never invented. ``fallback`` is
    honoured only on a ``local[...]`` master (tests, local runs).
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        local = spark.sparkContext.master.startswith("local")
        if fallback is None or not local:
            # on a cluster a machine-local folder would lose checkpoints with
            # the executor that wrote them
            raise RuntimeError("spark.checkpoint.dir is not set; configure a folder shared by all executors")
        root = fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def java_path(spark: SparkSession, path: str):
    """(file system, path) of the store that ``path`` is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    * scan splits of ``target_partition_bytes`` (256 MB): 100 TB -> ~400k
      tasks, about 100 waves on 1000 executors x 4 cores;
    * the same count of shuffle partitions as a ceiling, never below 3 per
      core (AQE coalesces down to the advisory size after each shuffle, and
      the daily roll-ups shuffle only partial aggregates, which are far
      smaller than their input);
    * skewed partitions (5x the median and over 512 MB) are split by AQE;
    * broadcast only below 64 MB measured size, so a growing side falls back
      to a sort-merge join.
    """
    cores = executors * cores_per_executor
    splits = max(1, input_bytes // target_partition_bytes)
    shuffle = max(3 * cores, splits)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
