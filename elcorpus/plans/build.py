"""End-to-end corpus build from files (the six stages, chained, restartable).

    python -m elcorpus.plans.build --categories DIR --html-pages PATH \
        --dump PATH --out DIR

Stage outputs are written as they are produced (the reference's file
contract: title list, link CSV, cleaned JSONL, error CSV, entity CSV,
gzip JSONL corpus/entities).  Each later stage reads what the earlier one
wrote, so lineage is cut at every stage boundary and a lost executor only
recomputes the current stage.  Stages that a later one reads as columns are
kept as Parquet under ``_build`` too; their CSV is for users.  The page HTML
itself comes from a previous fetch (the crawl is not part of this engine): J3
lists the (page, url) pairs still missing from it.

A stage that is done leaves a mark in ``_build/<run>``.  A build that was
ended goes on after its last mark; a stage without mark is done again from
its start.  Cleaning adds to the outputs of earlier builds; it commits its
rows at once (``streaming.CleanWriter``), so no title and no error is there
twice, wherever a build ends.  A build with other inputs, or one after a
complete build, is a new run of all stages.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from elcorpus.plans import dataset as D
from elcorpus.plans import entities as E
from elcorpus.plans import link_graph as L
from elcorpus.plans.titles import good_titles
from elcorpus.profile import MEDIAWIKI_FR, SiteProfile
from elcorpus.session import ensure_checkpoint_dir
from elcorpus.sinks import write_csv_quoted, write_gzip_jsonl, write_sorted_titles, write_titles
from elcorpus.sinks.commits import Files
from elcorpus.sources import (
    read_category_lines, read_cleaned_pages, read_html_pages, read_title_list, read_wikidata_dump,
)
from elcorpus.streaming.incremental import CleanWriter


class Run:
    """A build's marks: ``_build/<number>/<stage>.done``."""

    def __init__(self, spark: SparkSession, out: str, inputs: dict[str, str]):
        self.root, self.files = f"{out}/_build", Files(spark, out)
        numbers = [int(n) for n in self.files.names(self.root) if n.isdigit()]
        self.number = max(numbers, default=0)
        if not numbers or self.is_done("build") or json.loads(self.files.read(f"{self.folder}/inputs.json")) != inputs:
            self.number += 1
            self.files.mkdirs(self.folder)
            self.files.write(f"{self.root}/inputs-{self.number}", json.dumps(inputs))
            self.files.rename(f"{self.root}/inputs-{self.number}", f"{self.folder}/inputs.json")

    @property
    def folder(self) -> str:
        return f"{self.root}/{self.number:06d}"

    def is_done(self, stage: str) -> bool:
        return self.files.exists(f"{self.folder}/{stage}.done")

    def stage(self, name: str, work: Callable[[], None]) -> None:
        """Do ``work``, which replaces what it wrote before, unless done."""
        if not self.is_done(name):
            work()
            self.files.write(f"{self.folder}/{name}.done", "")

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"


class BuildCleanWriter(CleanWriter):
    """Cleaned pages as JSON lines, errors as CSV."""

    def write_cleaned(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)

    def write_errors(self, rows: DataFrame, path: str) -> None:
        write_csv_quoted(rows.select("title", "url", "error_class", "message"), path)


def run(spark: SparkSession, categories: str, html_pages: str, dump: str, out: str,
        profile: SiteProfile = MEDIAWIKI_FR) -> dict[str, str]:
    ensure_checkpoint_dir(spark)
    out = out.rstrip("/")
    paths = {k: f"{out}/{v}" for k, v in {
        "good": "list-good-pages", "links": "list-all-pages.csv", "all_pages": "list-all-pages",
        "frontier": "fetch-frontier.csv", "cleaned": "cleaned-pages.jl", "errors": "clean-errors.csv",
        "wikidata": "wikidata.csv", "corpus": "corpus.jsonl.gz", "entities": "entities.jsonl.gz"}.items()}
    this = Run(spark, out, {"categories": categories, "html_pages": html_pages, "dump": dump})

    def kept(name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(this.table(name))

    def table(name: str) -> DataFrame:
        return spark.read.parquet(this.table(name))

    # S1 good titles (sorted title file)
    this.stage("good", lambda: write_sorted_titles(good_titles(read_category_lines(spark, categories)), paths["good"]))
    good = read_title_list(spark, paths["good"], normalize=False)

    # fetched pages: parsed from JSON once, then read as a columnar table
    this.stage("pages", lambda: kept("pages", read_html_pages(spark, html_pages)))
    pages = table("pages")

    # S2 link graph of the good pages + list of pages; J3 pages still to fetch
    this.stage("link_rows", lambda: kept("links", L.link_graph(good, pages, profile)))
    links = table("links")
    this.stage("links", lambda: write_csv_quoted(links, paths["links"]))
    this.stage("all_pages", lambda: write_titles(L.all_pages(links).withColumnRenamed("page", "title"), paths["all_pages"]))
    this.stage("frontier", lambda: write_csv_quoted(L.fetch_frontier(links, pages.select("page")), paths["frontier"]))

    # S4 cleaning, resumable: titles already in the output are skipped
    this.stage("cleaned", lambda: BuildCleanWriter(paths["cleaned"], paths["errors"], profile).write(pages, "build", this.number))
    this.stage("cleaned_rows", lambda: kept("cleaned", read_cleaned_pages(spark, paths["cleaned"])))
    cleaned = table("cleaned")

    # S5 knowledge-base features of the entities met
    this.stage("wikidata_rows", lambda: kept("wikidata", E.entity_features(read_wikidata_dump(spark, dump), cleaned, profile)))
    wikidata = table("wikidata")
    this.stage("wikidata", lambda: write_csv_quoted(wikidata, paths["wikidata"]))

    # S6 corpus and entity tables
    corpus, entities = D.build_dataset(good, cleaned, wikidata)
    this.stage("corpus", lambda: write_gzip_jsonl(corpus, paths["corpus"]))
    this.stage("entities", lambda: write_gzip_jsonl(entities, paths["entities"]))
    this.stage("build", lambda: None)
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--categories", required=True)
    ap.add_argument("--html-pages", required=True)
    ap.add_argument("--dump", required=True)
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("elcorpus-build").getOrCreate()
    for k, v in run(spark, args.categories, args.html_pages, args.dump, args.out).items():
        print(k, v)


if __name__ == "__main__":
    main()
