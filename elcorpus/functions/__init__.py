"""Column-valued scalar functions (all JVM-side, no Python UDF)."""

from elcorpus.functions.strings import decode_entities, normalize_title, py_strip
from elcorpus.functions.titles import (
    cache_key, cache_path, is_main_ns_title, is_main_ns_url, wikipedia_description,
    wikipedia_url,
)
from elcorpus.functions.wikidata import (
    dump_item_qid, entity_aliases, entity_description, entity_label, entity_type,
    has_property, is_instance_of, type_flag,
)

__all__ = [
    "decode_entities", "normalize_title", "py_strip", "cache_key", "cache_path",
    "is_main_ns_title", "is_main_ns_url", "wikipedia_description", "wikipedia_url",
    "dump_item_qid", "entity_aliases", "entity_description", "entity_label", "entity_type",
    "has_property", "is_instance_of", "type_flag",
]
