"""An index of the titles done so far, read by the buckets of a batch.

The index is a list of generations.  A generation is a Parquet folder of
titles in ``2**bits`` buckets by title hash, with as many buckets as keep one
at about ``bucket_titles`` titles.  Adding writes a new generation; whenever
FANOUT generations have the same level they are merged into one of the next,
so there are about FANOUT * log(n) of them and a title is written log(n)
times.

A lookup takes from every generation only the buckets that the batch's own
titles fall into.  It reads at most (titles of the batch) x (generations) x
(titles of a bucket), whatever the size of the index.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from elcorpus.sinks.commits import Files

BUCKET_TITLES = 50_000
FANOUT = 4
TITLE_SCHEMA = "title string, bucket int"


def _bucket(title, bits: int):
    # low bits: a bucket of a larger generation lies in one of a smaller
    return F.pmod(F.xxhash64(title), F.lit(1 << bits)).cast("int")


class TitleIndex:
    """``generations``: dicts (name, level, bits, titles), oldest first."""

    def __init__(self, spark: SparkSession, path: str, generations=None, bucket_titles: int = BUCKET_TITLES, fanout: int = FANOUT):
        self.spark, self.path = spark, path.rstrip("/")
        self.generations = [dict(g) for g in generations or []]
        self.bucket_titles, self.fanout = bucket_titles, fanout
        self.files = Files(spark, path)

    def paths(self, titles: DataFrame) -> list[str]:
        """The bucket folders that titles (column ``title``) fall into."""
        if not self.generations:
            return []
        bits = max(g["bits"] for g in self.generations)
        touched = [r[0] for r in titles.select(_bucket(F.col("title"), bits).alias("b")).distinct().collect()]
        out = []
        for g in self.generations:
            have = {int(n.partition("=")[2]) for n in self.files.names(f"{self.path}/{g['name']}") if n.startswith("bucket=")}
            out += [f"{self.path}/{g['name']}/bucket={b}" for b in sorted({t % (1 << g["bits"]) for t in touched} & have)]
        return out

    def lookup(self, titles: DataFrame) -> DataFrame | None:
        """Titles of the index that share a bucket with ``titles``; every one
        of these that is in the index is among them.  None if there is none."""
        paths = self.paths(titles)
        return self.spark.read.schema("title string").parquet(*paths) if paths else None

    def all_titles(self) -> DataFrame | None:
        paths = [f"{self.path}/{g['name']}" for g in self.generations]
        frames = [self.spark.read.schema(TITLE_SCHEMA).parquet(p).select("title") for p in paths]
        out = None
        for f in frames:
            out = f if out is None else out.unionByName(f)
        return out

    def add(self, titles: DataFrame, name: str) -> None:
        """Add distinct titles that the index does not have, as generation
        ``name``, and merge what has reached its number.  Nothing that was
        there before is changed: older generations stay until ``sweep``."""
        added = self._written(titles.select("title"), titles.count(), name, 0)
        if added is None:
            return
        self.generations.append(added)
        level = 0
        while sum(g["level"] == level for g in self.generations) >= self.fanout:
            merged = [g for g in self.generations if g["level"] == level]
            rows = self.spark.read.schema(TITLE_SCHEMA).option("recursiveFileLookup", False)
            union = None
            for g in merged:
                own = rows.parquet(f"{self.path}/{g['name']}").select("title")
                union = own if union is None else union.unionByName(own)
            new = self._written(union, sum(g["titles"] for g in merged), f"{name}-{level + 1}", level + 1)
            self.generations = [g for g in self.generations if g["level"] != level] + [new]
            level += 1

    def _written(self, titles: DataFrame, count: int, name: str, level: int) -> dict | None:
        if not count:
            return None
        bits = max(0, math.ceil(math.log2(count / self.bucket_titles)))
        rows = titles.withColumn("bucket", _bucket(F.col("title"), bits))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")
        return {"name": name, "level": level, "bits": bits, "titles": count}

    def sweep(self) -> None:
        """Remove the folders that are no generation of the index."""
        live = {g["name"] for g in self.generations}
        for name in self.files.names(self.path):
            if name not in live:
                self.files.delete(f"{self.path}/{name}")
