"""Clean pages as they arrive, each exactly once.

A file stream of fetched pages (JSON lines) feeds ``foreachBatch``.  Each
micro-batch is anti-joined with the titles already done (resume rule E3),
cleaned with the same token-table plan as the batch stage, and reduced to the
first success per title (G1).  Cleaned rows, failed rows and the titles of
the batch are staged, committed together by one file, and then moved into the
output folders (``sinks.commits``).  A batch that is replayed after its
commit is left out; one that was ended before it is done again from the
start.  So neither a title nor an error row is there twice, wherever the
writer is ended.

The titles done so far are an index of hash buckets (``title_index``), of
which a batch reads those that its own titles fall into: the cost of a batch
does not grow with the output.  An output that is older than the index is
read once, when the index is made.

Row windows are not allowed on streaming DataFrames, which is why the work
runs inside ``foreachBatch`` on each (bounded) micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from elcorpus.operators.title_index import BUCKET_TITLES, TitleIndex
from elcorpus.plans.clean import clean_errors, cleaned_rows, first_clean_per_title
from elcorpus.profile import MEDIAWIKI_FR, SiteProfile
from elcorpus.session import ensure_checkpoint_dir
from elcorpus.sinks.commits import CommitLog
from elcorpus.sources.readers import HTML_PAGES_SCHEMA, read_existing_titles, with_input_seq, with_row_key


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class CleanWriter:
    """The micro-batches of one stream, written to ``out_path``/``err_path``."""

    def __init__(self, out_path: str, err_path: str, profile: SiteProfile = MEDIAWIKI_FR, bucket_titles: int = BUCKET_TITLES):
        self.out_path, self.err_path, self.profile, self.bucket_titles = out_path.rstrip("/"), err_path, profile, bucket_titles

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.out_path}_log", {"cleaned": self.out_path, "errors": self.err_path})

    def index(self, spark: SparkSession, state) -> TitleIndex:
        return TitleIndex(spark, f"{self.out_path}_titles", (state or {}).get("titles"), self.bucket_titles)

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # the id stays with the stream's checkpoint; a stream without it is another writer
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        self.write(batch, writer, epoch_id)

    def write(self, batch: DataFrame, writer: str, step: int) -> None:
        """Clean a batch as step ``step`` of ``writer``, unless it is done."""
        spark = batch.sparkSession
        log = self.log(spark)
        log.publish()
        last = log.last()
        if log.is_done(last, writer, step):
            return
        index = self.index(spark, last["state"])
        index.sweep()
        if last["state"] is None:
            earlier = read_existing_titles(spark, self.out_path)
            if earlier is not None:
                index.add(_written(earlier, log.staging(writer, step, "earlier")), f"{log.name(writer, step)}-earlier")
        pages = _written(with_row_key(with_input_seq(batch)), log.staging(writer, step, "pages"))
        known = index.lookup(pages.select(F.col("page").alias("title")))
        rows = _written(cleaned_rows(pages, self.profile, known), log.staging(writer, step, "rows"))
        self.write_cleaned(first_clean_per_title(rows).select("title", "url", "qid", "text"), log.staging(writer, step, "cleaned"))
        self.write_errors(clean_errors(rows).withColumn("epoch", F.lit(step)), log.staging(writer, step, "errors"))
        self.write_titles(index, rows.where("status = 'ok'").select("title").distinct(), log.name(writer, step))
        log.commit(last, writer, step, {"titles": index.generations})
        log.publish()

    def write_cleaned(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").json(path)

    def write_errors(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").json(path)

    def write_titles(self, index: TitleIndex, titles: DataFrame, name: str) -> None:
        index.add(titles, name)


def start_incremental_clean(spark: SparkSession, input_dir: str, out_path: str, err_path: str,
                            profile: SiteProfile = MEDIAWIKI_FR, checkpoint: str | None = None,
                            available_now: bool = True, max_files_per_trigger: int | None = None,
                            writer: CleanWriter | None = None):
    """Start the stream; returns the StreamingQuery.  Input records are
    (input_seq, page, url, text); ``input_seq`` orders duplicates.  Without a
    ``checkpoint`` the one beside the output is used, so that a restart goes
    on where the stream ended."""
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(HTML_PAGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(input_dir)
    w = (src.writeStream.foreachBatch(writer or CleanWriter(out_path, err_path, profile))
         .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}_checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


#: A state store on disk: state larger than the executors' memory spills.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def dedupe_titles(cleaned_stream: DataFrame, event_time: str, keep: str) -> DataFrame:
    """Streaming de-duplication of successful rows by title with bounded
    state: a title is known for ``keep`` (an interval, such as ``2 days``)
    after the ``event_time`` of its first row, and its later rows until then
    go.  A title that comes back after that is let through again; where every
    repetition has to go, however late, use I1, whose index is on disk.  Rows
    that are later than ``keep`` behind the newest ones are dropped.  The state
    holds the titles of twice ``keep`` and a batch.  Run with ``STATE_STORE``,
    so that it need not fit in memory."""
    return cleaned_stream.withWatermark(event_time, keep).dropDuplicatesWithinWatermark(["title"])
