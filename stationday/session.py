"""Session settings for the pipeline's plans.

``cluster_conf`` sizes shuffles and scans from the input volume so that a
task handles a few hundred MB: AQE then coalesces small shuffle partitions
and splits skewed ones at run time. ``local_session`` is the same set for
tests and benchmarks on one machine.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MB = 1 << 20
TARGET_PARTITION_BYTES = 256 * MB


def cluster_conf(input_bytes: int | None = None, cores: int | None = None,
                 target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings for a cluster run.

    Shuffle partitions: enough that each holds about ``target_partition_bytes``
    of the input (a conservative upper bound of a shuffle's size here, since
    every shuffle in these plans follows a partial aggregate or a pruned,
    column-projected scan), and at least two waves of the cluster's cores.
    """
    parts = 200
    if input_bytes:
        parts = max(parts, math.ceil(input_bytes / target_partition_bytes))
    if cores:
        parts = max(parts, 2 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # coalesce to the advisory size rather than keeping many small tasks
        # (Spark's advice for busy clusters)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        # the station dimension is broadcast only when its measured size is below this
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        # bounds file size in a partition written by one large task
        "spark.sql.files.maxRecordsPerFile": "20000000",
    }


def local_session(cpus: int = 8, app: str = "stationday", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = cluster_conf(cores=cpus)
    conf["spark.sql.shuffle.partitions"] = str(cpus)
    # one machine, small data: keep every core busy rather than coalescing to
    # the cluster's advisory size (measured: 1.6x slower on the sf0.1 bench)
    conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "true"
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": driver_memory,
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s
