"""Writers for every stage output."""

from elcorpus.sinks.writers import (
    append_csv, append_jsonl, write_csv_quoted, write_gzip_jsonl, write_sorted_titles,
    write_titles,
)

__all__ = ["append_csv", "append_jsonl", "write_csv_quoted", "write_gzip_jsonl",
           "write_sorted_titles", "write_titles"]
