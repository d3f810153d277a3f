"""Session construction and the shared scratch location.

Jobs that must cut lineage or write intermediate tables use the folder the
cluster names in ``spark.checkpoint.dir``. Only on a local master, where
driver and executors share one disk, is a folder created when that is unset;
on a cluster the missing setting is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is small), coalesces small
# shuffle partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the runtime settings above. Master and partition count
    are the caller's (or spark-submit's) choice and are set only if given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables, as the
    session names it (scheme included).

    A private one is made only on a plain local master; elsewhere executors
    would not see it, so an unset folder raises.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share "
                               f"(master is {sc.master})")
        root = "file://" + tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one job run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as parquet under the shared
    checkpoint folder and reading it back.

    Unlike ``Dataset.checkpoint()`` on an uncached input, which computes the
    data once to count it and again to write it, this computes it once. The
    files live on the cluster's shared storage, so a lost executor does not
    lose them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
