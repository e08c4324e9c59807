"""Readers.  Every read declares its schema (no inference); codecs come from
the file suffix (``.gz``, ``.bz2`` - bz2 text is splittable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from elcorpus.plans.titles import title_list
from elcorpus.profile import CATEGORY_FILE_GLOBS

HTML_PAGES_SCHEMA = T.StructType([
    T.StructField("input_seq", T.LongType()), T.StructField("page", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
CLEANED_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("qid", T.StringType()), T.StructField("text", T.StringType())])


def read_category_lines(spark: SparkSession, cat_dir: str, globs=CATEGORY_FILE_GLOBS) -> DataFrame:
    """A1: lines of the category listing files matching either name glob
    (one scan; a glob that matches nothing is not an error)."""
    pattern = "{" + ",".join(globs) + "}"
    return spark.read.option("pathGlobFilter", pattern).text(cat_dir)


def read_title_list(spark: SparkSession, path: str, normalize: bool = True) -> DataFrame:
    """A2: title list file -> distinct titles."""
    return title_list(spark.read.text(path), normalize=normalize)


def read_lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(value, place): the lines of a folder of text files, numbered from 1
    in the order of file names, blocks and lines.  Blocks are counted and
    their counts added up (a row for each block); lines are numbered within
    their block, so no task sees more than a block."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("line"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n_lines"))
    before = F.sum("n_lines").over(Window.orderBy("file", "block")) - F.col("n_lines")
    blocks = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), before.alias("before"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("line"))
    lines = lines.select("value", "file", "block", within.alias("within"))
    placed = lines.join(blocks, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    return placed.select("value", (F.col("before") + F.col("within")).cast("long").alias("place"))


def read_csv_strings(spark: SparkSession, path: str, columns) -> DataFrame:
    """A3: CSV with header where every column is a string and nothing is
    read as missing: quoted ``""`` stays ``''`` (Q14)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema)
            .options(header=True, escape='"', multiLine=True, nullValue="\u0000", emptyValue="")
            .csv(path))


def read_html_pages(spark: SparkSession, path: str) -> DataFrame:
    """A4: fetched pages as JSON lines (page, url, text).  ``input_seq`` is
    taken from the records when present; otherwise it is an ingest id
    (stable for a given file layout), which orders duplicates of a title.
    ``row_key`` tells the rows apart, also where records repeat an id."""
    return with_row_key(with_input_seq(spark.read.schema(HTML_PAGES_SCHEMA).json(path)))


def with_input_seq(pages: DataFrame) -> DataFrame:
    """Fill a missing ``input_seq`` by the row's place.  The ids made here are
    negative, so they never meet an id that a record carries."""
    made = F.monotonically_increasing_id() - F.lit(1 << 62)
    return pages.withColumn("input_seq", F.coalesce(F.col("input_seq"), made))


def with_row_key(pages: DataFrame) -> DataFrame:
    """A key of its own for every input row, whatever ids the records carry:
    ``input_seq`` orders pages, it does not tell them apart."""
    return pages if "row_key" in pages.columns else pages.withColumn("row_key", F.monotonically_increasing_id())


def read_cleaned_pages(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned pages (title, url, qid, text) as JSON lines."""
    return spark.read.schema(CLEANED_SCHEMA).json(path)


def read_wikidata_dump(spark: SparkSession, path: str) -> DataFrame:
    """A5: raw dump text lines (``value``); see plans.entities.dump_lines."""
    return spark.read.text(path)


def read_existing_titles(spark: SparkSession, path: str) -> DataFrame | None:
    """Titles of a previous cleaning output, or None if there is none."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    return read_cleaned_pages(spark, path).select("title").distinct()
