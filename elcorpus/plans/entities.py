"""Knowledge-base features of the entities met in cleaned pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.functions.strings import py_strip
from elcorpus.functions.wikidata import (
    dump_item_qid, entity_aliases, entity_description, entity_label, entity_type, parse_item,
    p31_ids,
)
from elcorpus.operators.bit_filter import maybe_among
from elcorpus.profile import ALIAS_SEPARATOR, MEDIAWIKI_FR, SiteProfile


def dump_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """A5: dump text lines -> item JSON lines (strip, skip brackets and
    blank lines, drop the trailing comma)."""
    s = py_strip(F.col(value))
    return (raw.select(s.alias("line")).filter(~F.col("line").isin("[", "]", ""))
            .select(F.regexp_replace("line", ",$", "").alias("line")))


def dump_items(lines: DataFrame) -> DataFrame:
    """C11: (qid, line) of item lines; other entity kinds fall out."""
    return lines.select(dump_item_qid(F.col("line")).alias("qid"), "line").filter(F.col("qid") != "")


def known_qids(cleaned: DataFrame) -> DataFrame:
    """Distinct non-empty qids of the cleaned pages."""
    return cleaned.select("qid").filter(F.col("qid") != "").distinct()


def wanted_items(items: DataFrame, qids: DataFrame) -> DataFrame:
    """E1 + Q7: items whose qid was seen, one row per qid (smallest line),
    still unparsed.  A bounded filter drops nearly all other lines where they
    are read; the join, which carries no hint, decides on the rest."""
    kept = maybe_among(items, qids, "qid").join(qids, "qid", "left_semi")
    return kept.groupBy("qid").agg(F.min("line").alias("line"))


def features(items: DataFrame, profile: SiteProfile = MEDIAWIKI_FR) -> DataFrame:
    """H7-H12 on (qid, line): description, label, aliases ('::'), type."""
    it = items.select("qid", parse_item(F.col("line"), profile.language).alias("it"))
    it = it.select("qid", "it", p31_ids(F.col("it")).alias("ids"))
    return it.select(
        "qid",
        entity_description(F.col("it"), profile.language).alias("wikidata_description"),
        entity_label(F.col("it"), profile.language).alias("label"),
        entity_aliases(F.col("it"), profile.language, ALIAS_SEPARATOR).alias("aliases"),
        entity_type(F.col("it"), F.col("ids")).alias("type"),
    )


def entity_features(raw_dump: DataFrame, cleaned: DataFrame, profile: SiteProfile = MEDIAWIKI_FR) -> DataFrame:
    """(qid, wikidata_description, label, aliases, type)."""
    items = dump_items(dump_lines(raw_dump))
    return features(wanted_items(items, known_qids(cleaned)), profile)
