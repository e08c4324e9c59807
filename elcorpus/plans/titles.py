"""Good-article titles from category listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.functions.strings import normalize_title
from elcorpus.profile import CATEGORY_LABEL_PATTERN

LABEL_REGEX = "(?d)" + CATEGORY_LABEL_PATTERN


def good_titles(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct titles named by the first ``{{a-label|..}}`` of bullet
    lines, stripped, spaces as ``_``.  Sort with ``orderBy('title')`` when
    writing (B1)."""
    m = lines.filter(F.col(value).rlike(LABEL_REGEX))
    return m.select(normalize_title(F.regexp_extract(value, LABEL_REGEX, 1)).alias("title")).distinct()


def title_list(lines: DataFrame, value: str = "value", normalize: bool = True) -> DataFrame:
    """A2: a title-list file as distinct titles; ``normalize`` strips and
    replaces spaces (blank lines dropped), else lines are kept raw."""
    if normalize:
        return (lines.filter(F.regexp_replace(value, r"(?U)\s", "") != "")
                .select(normalize_title(F.col(value)).alias("title")).distinct())
    return lines.filter(F.col(value) != "").select(F.col(value).alias("title")).distinct()
