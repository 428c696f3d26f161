"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Private folders of local sessions that name none, by application.
_PRIVATE: dict[str, str] = {}


def build_session(
    app_name: str = "icdspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session tuned for DataFrame work: AQE on, UI off, UTC, Arrow on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and let the
    cluster configuration decide; tests and the bench pass ``local[N]`` and a
    small partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20, cores: int | None = None) -> dict[str, str]:
    """Partition sizing for a target input volume (e.g. 100 TB on a large cluster).

    Shuffles start with about one partition per ``partition_bytes`` of input
    (never fewer than 2 x cores), AQE then coalesces small ones towards the
    advisory size and splits skewed join partitions; scans split files at the
    same size.  Every task therefore holds a bounded slice that can spill.
    """
    parts = max(2 * (cores or 1), -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a folder there that all its machines reach.  Only a local
    session may leave it out and gets a private folder; anywhere else that
    would be lost or invisible to the executors, so it is an error.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _PRIVATE:
            _PRIVATE[app] = tempfile.mkdtemp(prefix="icdspark-ckpt-")
        current = _PRIVATE[app]
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), *parts])


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark keeps it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
