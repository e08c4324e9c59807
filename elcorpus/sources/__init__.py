"""Schema-first readers for every stage input."""

from elcorpus.sources.readers import (
    CLEANED_SCHEMA, HTML_PAGES_SCHEMA, read_category_lines, read_cleaned_pages, read_csv_strings,
    read_existing_titles, read_html_pages, read_lines_in_order, read_title_list, read_wikidata_dump, with_input_seq,
    with_row_key,
)

__all__ = ["CLEANED_SCHEMA", "HTML_PAGES_SCHEMA", "read_category_lines", "read_cleaned_pages",
           "read_csv_strings", "read_existing_titles", "read_html_pages", "read_lines_in_order",
           "read_title_list", "read_wikidata_dump", "with_input_seq", "with_row_key"]
