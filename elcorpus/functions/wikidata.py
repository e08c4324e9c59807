"""Knowledge-base item features as Column expressions.

An item line is parsed once with ``from_json`` against a narrow schema (only
the profile language, claims as raw JSON per property), so the parser skips
everything else in the line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from elcorpus.profile import DUMP_ITEM_PATTERN, OTHER_TYPE, TYPE_RULES

P31_SCHEMA = "array<struct<mainsnak:struct<datavalue:struct<value:struct<id:string>>>>>"


def item_schema(language: str = "fr") -> str:
    lang = f"`{language}`"
    return (f"struct<labels:struct<{lang}:struct<value:string>>,"
            f"descriptions:struct<{lang}:struct<value:string>>,"
            f"aliases:struct<{lang}:array<struct<value:string>>>,"
            f"claims:map<string,string>>")


def parse_item(line: Column, language: str = "fr") -> Column:
    """Struct with labels/descriptions/aliases (one language) and claims."""
    return F.from_json(line, item_schema(language))


def dump_item_qid(line: Column) -> Column:
    """Item id of a dump line, ``''`` for property/lexeme/other lines."""
    return F.regexp_extract(line, DUMP_ITEM_PATTERN, 1)


def entity_label(item: Column, language: str = "fr") -> Column:
    return F.coalesce(item["labels"][language]["value"], F.lit(""))


def entity_description(item: Column, language: str = "fr") -> Column:
    return F.coalesce(item["descriptions"][language]["value"], F.lit(""))


def entity_aliases(item: Column, language: str = "fr", sep: str | None = "::") -> Column:
    """Alias values in order; joined with ``sep`` unless ``sep`` is None."""
    values = F.transform(F.coalesce(item["aliases"][language], F.array()), lambda a: a["value"])
    return values if sep is None else F.array_join(values, sep)


def p31_ids(item: Column) -> Column:
    """Target ids of the P31 claims in order; null where a claim has none."""
    claims = F.from_json(item["claims"]["P31"], P31_SCHEMA)
    return F.transform(F.coalesce(claims, F.array()),
                       lambda c: c["mainsnak"]["datavalue"]["value"]["id"])


def is_instance_of(ids: Column, instances) -> Column:
    """Scan claims in order: true at the first id in ``instances``, false at
    the first claim without an id (an earlier match still wins)."""
    inst = F.array(*[F.lit(i) for i in instances])
    hit = F.array_position(F.transform(ids, lambda x: F.coalesce(F.array_contains(inst, x), F.lit(False))), True)
    bad = F.array_position(F.transform(ids, lambda x: x.isNull()), True)
    return (hit > 0) & ((bad == 0) | (hit < bad))


def has_property(item: Column, properties) -> Column:
    keys = F.map_keys(item["claims"])
    props = F.array(*[F.lit(p) for p in properties])
    return F.coalesce(F.arrays_overlap(keys, props), F.lit(False))


def type_flag(item: Column, ids: Column, type_name: str) -> Column:
    for name, instances, properties in TYPE_RULES:
        if name == type_name:
            return is_instance_of(ids, instances) | has_property(item, properties)
    raise KeyError(type_name)


def entity_type(item: Column, ids: Column | None = None) -> Column:
    """First type rule that holds (DATE > PERSON > GEOLOC > ORG), else OTHER."""
    ids = p31_ids(item) if ids is None else ids
    expr = None
    for name, _, _ in TYPE_RULES:
        cond = type_flag(item, ids, name)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_TYPE))
