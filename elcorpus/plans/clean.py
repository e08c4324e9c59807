"""Clean HTML pages into annotated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.operators import html as H
from elcorpus.profile import MEDIAWIKI_FR, SiteProfile
from elcorpus.session import ensure_checkpoint_dir, materialize
from elcorpus.sources.readers import with_row_key

ERR_NO_CONTAINER = ("IndexError", "list index out of range")
ERR_MATH_ALT = ("KeyError", "'alt'")


def cleaned_rows(html_pages: DataFrame, profile: SiteProfile = MEDIAWIKI_FR,
                 already: DataFrame | None = None, num_partitions: int | None = None) -> DataFrame:
    """Every input row cleaned: (row_key, input_seq, title, url, qid, text,
    status, error_class, message).  Titles in ``already`` (E3) are skipped
    before any tokenising.  One scan, one Exchange by the row key; title, url
    and ``input_seq`` travel on the page's first token."""
    pages = with_row_key(html_pages)
    if already is not None:
        pages = pages.join(already.select(F.col("title").alias("page")).distinct(), "page", "left_anti")
    carry = ("input_seq", "page", "url")
    src = H.partition_pages(pages.select("row_key", *carry, "text"), "row_key", num_partitions, "text")
    src = src.select(F.col("row_key").alias("pk"), F.col("text").alias("html"), F.struct(*carry).alias("page"))
    toks = H.tokenize(src, partitioned=True, carry=("page",))
    j = H.page_results(H.annotate(toks, profile, carry=("page",)), profile, carry=("page",))
    c = F.col
    err_class = (F.when(~c("exists"), F.lit(None))
                 .when(~c("has_container"), F.lit(ERR_NO_CONTAINER[0]))
                 .when(c("math_error"), F.lit(ERR_MATH_ALT[0])))
    message = (F.when(~c("exists"), F.lit(None))
               .when(~c("has_container"), F.lit(ERR_NO_CONTAINER[1]))
               .when(c("math_error"), F.lit(ERR_MATH_ALT[1])))
    return j.select(
        c("pk").alias("row_key"), c("page.input_seq").alias("input_seq"), c("page.page").alias("title"), c("page.url").alias("url"),
        F.when(c("exists"), c("qid")).otherwise(F.lit("")).alias("qid"),
        F.when(c("exists"), c("text")).otherwise(F.lit("")).alias("text"),
        F.when(err_class.isNull(), F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        err_class.alias("error_class"), message.alias("message"),
    )


def first_clean_per_title(rows: DataFrame) -> DataFrame:
    """G1: per title, the first successful row in input order.  The row is
    found by a grouped min over the order alone (partial aggregation, so a
    title repeated in a third of all rows costs one row per map task) and
    picked by its key; texts are not grouped.  ``rows`` is read twice: a
    written table."""
    ok = rows.filter(F.col("status") == "ok")
    best = ok.groupBy("title").agg(F.min(F.struct("input_seq", "row_key")).alias("b")).select("b.row_key")
    return ok.join(best, "row_key", "left_semi").select("title", "url", "qid", "text", "input_seq")


def clean_errors(rows: DataFrame) -> DataFrame:
    """Failed rows met before the title's first success (later rows of
    a title are never tried once it succeeded)."""
    ok_seq = (rows.filter(F.col("status") == "ok").groupBy(F.col("title").alias("ok_title"))
              .agg(F.min(F.struct("input_seq", "row_key")).alias("first_ok")))
    err = rows.filter(F.col("status") == "error")
    j = err.join(ok_seq, err["title"].eqNullSafe(F.col("ok_title")), "left")
    return (j.filter(F.col("first_ok").isNull() | (F.struct("input_seq", "row_key") < F.col("first_ok")))
            .select("input_seq", "title", "url", "error_class", "message"))


def clean_pages(html_pages: DataFrame, profile: SiteProfile = MEDIAWIKI_FR,
                already: DataFrame | None = None, num_partitions: int | None = None):
    """J4 -> (cleaned: title, url, qid, text; errors).  The rows are cleaned
    once and written; both results read them."""
    ensure_checkpoint_dir(html_pages.sparkSession)
    rows = materialize(cleaned_rows(html_pages, profile, already, num_partitions), "clean-rows")
    return first_clean_per_title(rows).drop("input_seq"), clean_errors(rows)
