"""Link graph of the good pages and the fetch frontier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.functions.titles import cache_key, wikipedia_url
from elcorpus.operators import html as H
from elcorpus.profile import MEDIAWIKI_FR, SiteProfile
from elcorpus.session import ensure_checkpoint_dir, materialize
from elcorpus.sources.readers import with_row_key


def seed_pages(good: DataFrame, html_pages: DataFrame) -> DataFrame:
    """Each good title with its page HTML (the first fetched row of the
    title): (title, input_seq, row_key, text).  Pages are narrowed to good
    titles and written once; the first fetch is a grouped min over the order
    alone (partial aggregation, so a title fetched in a third of all rows
    stays cheap) and the HTML is picked by the row's key - the HTML itself is
    never grouped.  The joins carry no hint: adaptive execution picks the
    side to broadcast by size."""
    ensure_checkpoint_dir(html_pages.sparkSession)
    good_t = good.select(F.col("title").alias("page")).distinct()
    cand = with_row_key(html_pages).select("row_key", "input_seq", "page", "text").join(good_t, "page", "left_semi")
    cand = materialize(cand, "seed-candidates")
    first = cand.groupBy("page").agg(F.min(F.struct("input_seq", "row_key")).alias("b")).select("b.row_key")
    picked = cand.join(first, "row_key", "left_semi")
    return picked.select(F.col("page").alias("title"), "input_seq", "row_key", "text")


def link_graph(good: DataFrame, html_pages: DataFrame, profile: SiteProfile = MEDIAWIKI_FR,
               num_partitions: int | None = None) -> DataFrame:
    """(page, linked_from, url): one seed row per good title
    (``linked_from=''``) plus one row per internal link of its page (multi
    edges kept).  Pages absent, missing or without container give the seed
    row only."""
    good = good.select("title").distinct()
    seeds = good.select(F.col("title").alias("page"), F.lit("").alias("linked_from"),
                        wikipedia_url(F.col("title"), profile).alias("url"))
    seed = seed_pages(good, html_pages)
    # one more than the number of a join: Spark would let the shuffle by the
    # same key that picks the seeds stand in for this one, and coalesce it
    num_partitions = num_partitions or H.page_partitions(seed, "text") + 1
    sp = H.partition_pages(seed.select(F.col("row_key").alias("pk"), F.col("text").alias("html")), "pk", num_partitions)
    links = H.link_tokens(H.annotate(H.tokenize(sp, partitioned=True), profile))
    edges = links.join(seed.select(F.col("row_key").alias("pk"), F.col("title").alias("linked_from")), "pk")
    edges = edges.select(F.replace(F.col("title"), F.lit(" "), F.lit("_")).alias("page"), "linked_from",
                         F.concat(F.lit(profile.host), F.col("href")).alias("url"))
    return seeds.unionByName(edges)


def all_pages(page_links: DataFrame) -> DataFrame:
    """distinct pages (seeds and link targets)."""
    return page_links.select("page").distinct()


def frontier_distinct(page_links: DataFrame) -> DataFrame:
    """Distinct (page, url) pairs to fetch."""
    return page_links.select("page", "url").distinct()


def fetch_frontier(page_links: DataFrame, cached: DataFrame | None = None) -> DataFrame:
    """Distinct (page, url) whose title is not fetched yet (E4).  Pages
    are keyed by title: titles that share a cache key are all fetched."""
    todo = frontier_distinct(page_links)
    if cached is None:
        return todo
    done = cached.select(F.replace(F.col("page"), F.lit(" "), F.lit("_")).alias("page")).distinct()
    return todo.join(done, "page", "left_anti")


def cache_key_collisions(titles: DataFrame, title: str = "title") -> DataFrame:
    """Cache keys shared by more than one distinct title (Q12 report)."""
    return (titles.select(cache_key(F.col(title)).alias("key"), F.col(title).alias("title")).distinct()
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_titles"))
            .filter(F.col("n_titles") > 1))
