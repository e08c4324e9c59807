"""Final corpus and entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.functions.titles import wikipedia_description
from elcorpus.operators.joins import left_join_hot_key

ENTITY_COLUMNS = ("qid", "title", "url", "wikipedia_description", "wikidata_description", "label",
                  "aliases", "type")


def corpus(good: DataFrame, cleaned: DataFrame) -> DataFrame:
    """E5: cleaned pages whose title is a good title -> (title, qid, text)."""
    return cleaned.join(good.select("title").distinct(), "title", "left_semi").select("title", "qid", "text")


def entities(cleaned: DataFrame, wikidata: DataFrame) -> DataFrame:
    """Every cleaned page with its description and knowledge-base
    features; null features when the qid is '' or unknown.  Pages without
    qid bypass the join (hot key)."""
    frwiki = cleaned.select("qid", "title", "url", wikipedia_description(F.col("text")).alias("wikipedia_description"))
    wd = wikidata.select("qid", "wikidata_description", "label", "aliases", "type")
    return left_join_hot_key(frwiki, wd, "qid", [""]).select(*ENTITY_COLUMNS)


def build_dataset(good: DataFrame, cleaned: DataFrame, wikidata: DataFrame):
    """J6 -> (corpus, entities)."""
    return corpus(good, cleaned), entities(cleaned, wikidata)


def last_write_wins(rows: DataFrame, key: str = "title", order: str = "input_seq") -> DataFrame:
    """Of the rows of a key the one written last, ``order`` being unique
    within a key.  The last one is found by a primitive grouped max (partial
    aggregation, so a hot key costs one row per map task); the rows' texts
    are never sorted or grouped.  A null key counts as a key."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_last"))
    return rows.join(last, rows[key].eqNullSafe(F.col("_key")) & (rows[order] == F.col("_last")), "left_semi")
