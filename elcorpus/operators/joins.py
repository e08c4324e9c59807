"""Join helpers: hot-key splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_hot_key(left: DataFrame, right: DataFrame, key: str, hot_values) -> DataFrame:
    """Left equi-join where rows whose key is a known hot value (e.g. ``''``)
    bypass the join and get null right-side columns, so they never pile up
    in one shuffle partition."""
    hot = F.col(key).isin(*hot_values) | F.col(key).isNull()
    joined = left.filter(~hot).join(right, key, "left")
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    bypass = left.filter(hot).select(*left.columns, *extra)
    return joined.unionByName(bypass)
