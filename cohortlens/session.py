"""Session settings every plan relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone for epoch -> month keys) or the
# physical plan at scale (AQE, skew join, runtime broadcast threshold).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 10 MiB: AQE turns a join into a broadcast only when the *measured*
    # shuffle output of one side is below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings (idempotent; safe on a shared session)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without one gets a scratch folder; on a cluster a
    machine-local folder would be invisible to the other executors, so a
    missing setting raises there.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
            d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path for intermediate tables, shared by all executors.

    All of an application's scratch lies in one folder of the checkpoint
    folder, which is deleted when the application's JVM ends.
    """
    sc = spark.sparkContext
    base = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{sc.applicationId}"
    root = sc._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        fs.mkdirs(root)
        fs.deleteOnExit(root)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the application's scratch folder and read back: its work is done once, its lineage ends."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens") -> SparkSession:
    """Session used by tests and the bench (single JVM, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEM", "8g"))
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
