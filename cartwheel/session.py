"""Session helpers: a tuned local session for tests and a shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: With it, Spark removes the shuffle files of a query as soon as the query has ended, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cartwheel", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster the master and partition count come from spark-submit; these defaults only
    apply where nothing is configured, i.e. in tests and local benchmarks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # checkpoint files of dropped intermediates are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM: its heap is the executor memory
        builder = builder.config("spark.driver.memory", driver_memory or os.environ.get("CARTWHEEL_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session; only when it is unset and the master is local (tests) a
    scratch folder is created and registered. On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to other executors: refuse instead of guessing
            raise ValueError("set spark.checkpoint.dir to a folder on the cluster's shared file system")
        conf_dir = tempfile.mkdtemp(prefix="cartwheel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as compressed Parquet under ``spark.checkpoint.dir``, read back. Lineage is cut, and the shuffle files it was made from are gone.

    For tables that grow: a checkpoint is not compressed. A side of a join that comes from here is not broadcast unless the join
    says so, as Spark would compare ``autoBroadcastJoinThreshold`` with the size of compressed files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    with _freeing(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).hint("merge")


def settled(df: DataFrame) -> DataFrame:
    """``df`` in a checkpoint, for small tables and those whose layout matters; the shuffle files it was made from are gone."""
    ensure_checkpoint_dir(df.sparkSession)
    with _freeing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a new plan, which is made under the setting
