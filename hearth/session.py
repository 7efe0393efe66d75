"""Session construction and lineage management."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "hearth",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session.

    Master, memory and partitions are set only where the caller or the
    environment names them; everything else comes from the cluster's
    configuration (or spark-submit).  A plain Python process without any of
    these gets a local session with 8 GB."""
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    memory = os.environ.get("HEARTH_DRIVER_MEMORY")
    if not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        master, memory = master or "local[*]", memory or "8g"
    if master:
        builder = builder.master(master)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``,
    or the context's checkpoint folder.  Where neither is set, a local master
    (driver and executors are one process) gets a scratch folder; any other
    master is refused, since each executor would write to its own disk."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="hearth-ckpt-")
        sc.setCheckpointDir(named)  # a core setting cannot be set in a running session
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lost
    executor reads the files again, and later reads take only their columns.
    The tables lie under ``tables/`` of the shared folder until
    ``drop_tables``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> bool:
    """Delete the tables that ``cut_lineage`` wrote; frames built on them end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/tables")
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
