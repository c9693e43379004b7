"""Session creation and lineage cutting.

The master is left to the deployer (spark-submit / cluster manager); only a
test or a local run passes one. Adaptive execution is switched on so that the
shuffle partition count, skewed partitions and join strategy are re-planned at
run time from real sizes.

Wide projections (many derived columns plus pushed-down filters) generate
large Java methods. HotSpot does not JIT-compile methods over 8000 bytes of
bytecode by default, and such a stage then runs interpreted, several times
slower. ``-XX:-DontCompileHugeMethods`` lifts that limit for the driver and
the executors; it takes effect when this builder starts the JVMs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(
    app_name: str = "aerolens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    max_partition_bytes: str | None = None,
    advisory_partition_bytes: str | None = None,
) -> SparkSession:
    """Get or create a session with adaptive execution enabled.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces it
    down from real map output sizes, so on a cluster set it high (a few times
    the total executor cores) and let AQE shrink it.
    ``max_partition_bytes`` caps the input split size of file scans and
    ``advisory_partition_bytes`` is the post-shuffle size AQE aims for (and
    splits skewed partitions towards); both are Spark size strings such as
    "256m". Size them so one task's data fits its share of executor memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Remove checkpoint files once the frames that use them are gone.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    if advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = advisory_partition_bytes
    for side in ("driver", "executor"):
        conf[f"spark.{side}.extraJavaOptions"] = JIT_OPTIONS
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or None if unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    return None


def stable(df: DataFrame) -> DataFrame:
    """``df`` materialised by a reliable ``checkpoint`` in the shared folder:
    lineage is cut and the data survives the loss of any executor; the files
    go once the frame is no longer referenced. Without a folder the frame
    stays as it is, so the rows are the same and later reads compute it anew;
    nothing is left in executors' memory either way.
    """
    return df.checkpoint(eager=True) if checkpoint_dir(df.sparkSession) else df
