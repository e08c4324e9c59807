"""The corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from elcorpus.llm import decontaminate, jaccard_join, language_id, packing, secrets
from elcorpus.llm.common import scratch_dir, table
from elcorpus.llm.queries import _tokenizer


#: Documents whose language is less probable than this are rejected.
LEAST_LANGUAGE_SCORE = 0.4


#: Rows and bytes in a batch between an executor and its Python workers.  Whole
#: texts lie in the batches of both at once; Spark's 10,000 rows take tens of
#: megabytes for each copy, which neither side gives back after it, and the
#: workers of all stages share a machine.  Rows without texts are narrow, so
#: the bytes leave their batches as they are.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "1m")


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage with batches of BATCH_BYTES, whoever calls it.  Its last part
    runs when the caller writes the rows, so the session keeps the setting;
    ``run`` sets back what it found."""

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column has them (in any case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


@small_batches
def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty ones too) or without a
    probable language go; ``lang`` stays as it was given.  Repeated rows are
    judged each, an empty table gives an empty one, columns of any name
    stay."""
    names = fresh(docs, "lang_pred", "score")
    learn = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())
    judged = language_id.predictions(docs, language_id.train(learn), names=tuple(names))
    return judged.where((F.col(names[0]) != "und") & (F.col(names[1]) >= LEAST_LANGUAGE_SCORE)).drop(*names)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one that names its component
    (of repeated rows of that id, one for each text).  Null and empty texts
    are in no group and stay; columns of any name stay."""
    kept_id, kept_rows = fresh(docs, "kept_id", "kept_rows")
    found = jaccard_join.near_duplicates(docs.select("doc_id", "text"))
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(kept_id)).agg(F.count("*").alias(kept_rows))
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[kept_id])).drop(kept_id)
    once = rows.where(F.col(kept_rows) == 1).drop(kept_rows)
    return once.unionByName(rows.where(F.col(kept_rows) > 1).drop(kept_rows).dropDuplicates(["doc_id", "text"]))


@small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; what has nothing else goes.  Null and
    empty texts have no passage and stay."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


@small_batches
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes (null texts stay
    null)."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


@small_batches
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left (null text: the end alone);
    repeated rows are packed each."""
    return packing.pack(docs, _tokenizer())


STAGES = [
    ("language_identification", language_identification),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("sequence_packing", sequence_packing),
]

#: Tokenised pieces and trained models cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    old = {name: spark.conf.get(name) for name, _ in (BATCH_ROWS, BATCH_BYTES)}
    spark.conf.set(*BATCH_ROWS)
    try:
        for name, stage in STAGES[:-1]:
            path = f"{scratch_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        return STAGES[-1][1](spark, docs, sf_dir)  # its workers' part is written there
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
