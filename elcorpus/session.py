"""Session helpers.

Library code never invents storage locations: stage outputs that cut
lineage go to the folder named by ``spark.checkpoint.dir`` (a shared
folder on a cluster).  Where the session has none, a local one gets a
scratch folder, and any other is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "elcorpus") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # a window group is one page: keep a whole page in the fast buffer
        .config("spark.sql.windowExec.buffer.in.memory.threshold", "262144")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  Only a local session that
    names none gets a scratch folder; a cluster must name a shared one."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder")
        current = tempfile.mkdtemp(prefix="elcorpus-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for a written stage table."""
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; cannot place stage table {name}")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` once as a parquet stage table under the checkpoint
    folder and return a DataFrame reading it back.

    This cuts the lineage (later stages and size checks read the table,
    they do not recompute the plan), survives executor loss (the table is
    on shared storage), and costs one pass - unlike ``checkpoint()``, which
    computes an unpersisted plan twice."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
