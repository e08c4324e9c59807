"""Writers.  Outputs are folders of part files written in parallel; a single
file (``coalesce(1)``) is only produced when asked for, since it funnels the
whole output through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_sorted_titles(titles: DataFrame, path: str, single_file: bool = False) -> None:
    """B1: distinct titles in code-point order, one per line.  The sort is a
    range-partitioned global sort, so part files are in order."""
    df = titles.select("title").distinct().orderBy("title")
    (df.coalesce(1) if single_file else df).write.mode("overwrite").text(path)


def write_titles(titles: DataFrame, path: str) -> None:
    """B2: distinct titles, no order."""
    titles.select("title").distinct().write.mode("overwrite").text(path)


def write_csv_quoted(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, every field quoted, quotes doubled."""
    df.write.mode(mode).options(header=True, quoteAll=True, escape='"').csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append (each part file carries its own header)."""
    write_csv_quoted(df, path, mode="append")


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append JSON lines."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_gzip_jsonl(df: DataFrame, path: str) -> None:
    """Gzip JSON lines with every key present (null kept)."""
    df.write.mode("overwrite").options(compression="gzip", ignoreNullFields=False).json(path)
