"""Storage, inputs and row keys shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a local
    session that names none gets a temporary folder of its own."""
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder")
        base = tempfile.mkdtemp(prefix="elcorpus-llm-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and reread: cuts
    the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    store, there = _folder(spark, path)
    return store.exists(there)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a stage table that no later job reads."""
    store, there = _folder(spark, path)
    store.delete(there, True)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for a context."""
    sc = spark.sparkContext
    if getattr(sc, "_elcorpus_llm_sent", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="elcorpus-code-"), "elcorpus_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for sub in ("elcorpus", "elcorpus/llm"):
            for name in sorted(os.listdir(os.path.join(root, sub))):
                if name.endswith(".py"):
                    z.write(os.path.join(root, sub, name), f"{sub}/{name}")
    sc.addPyFile(path)
    sc._elcorpus_llm_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, n: int):
    """crc32 of a key as text, modulo ``n`` (null keys: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, id_col, text_col): a key for each row, equal rows included."""
    ship(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("row_key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def shuffle_parts(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sampled(rows: DataFrame, by: str, per_value: int, seed: int, key: str = "doc_id") -> DataFrame:
    """About ``per_value`` rows (at most twice as many overall) of each value
    of ``by``, by a hash of the key: a bounded sample for a classifier."""
    sizes = rows.groupBy(by).count().withColumnRenamed("count", "value_rows")
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    values = sizes.count()
    return rows.join(F.broadcast(sizes), by).where(share < per_value / F.col("value_rows")).orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), key).limit(2 * per_value * max(1, values)).drop("value_rows")
