"""String helpers: Unicode strip, title normalisation, HTML entity decoding."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading/trailing characters removed by a Unicode-aware strip: Java's
# Unicode white space plus the information separators 0x1c-0x1f.
STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# A character reference: named, decimal or hexadecimal, with semicolon.
ENTITY_PATTERN = r"&(?:[a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);"


def py_strip(c: Column) -> Column:
    """Strip Unicode white space from both ends (like ``str.strip()``)."""
    return F.regexp_replace(c, STRIP_PATTERN, "")


def normalize_title(c: Column, strip: bool = True) -> Column:
    """Title as used in page names: stripped, spaces replaced by ``_``."""
    return F.replace(py_strip(c) if strip else c, F.lit(" "), F.lit("_"))


_MAP_CACHE: dict = {}


def _sql_str(v: str) -> str:
    return "'" + "".join(f"\\u{ord(ch):04x}" for ch in v) + "'"


def _named_entity_map() -> Column:
    """HTML 4 named entities (the set an HTML parser decodes), plus apos, as
    one constant map built from a single SQL expression (cached per
    SparkContext: one JVM call instead of hundreds)."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    key = id(sc)
    if key not in _MAP_CACHE:
        table = dict(name2codepoint)
        table.setdefault("apos", 39)
        names = sorted(table)
        sql = ("map_from_arrays(array(" + ", ".join(_sql_str(n) for n in names) + "), array("
               + ", ".join(_sql_str(chr(table[n])) for n in names) + "))")
        _MAP_CACHE.clear()
        _MAP_CACHE[key] = F.expr(sql)
    return _MAP_CACHE[key]


def _code_point_to_string(n: Column) -> Column:
    # UTF-32 big-endian bytes of the code point, decoded.
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _decode_one(ref: Column, names: Column) -> Column:
    body = F.substring(ref, 2, F.length(ref) - 2)        # without & and ;
    is_hex = body.startswith("#x") | body.startswith("#X")
    is_dec = body.startswith("#") & ~is_hex
    digits = F.regexp_replace(body, "^#[xX]?0*", "")
    short = F.when(F.length(digits) <= 8, digits)        # longer ones are no code points
    hex_val = F.conv(F.when(is_hex, short), 16, 10).cast("long")
    dec_val = F.when(is_dec, short).try_cast("long")
    valid = lambda n: (n > 0) & (n <= 0x10FFFF) & ((n < 0xD800) | (n > 0xDFFF))
    decoded = (
        F.when(is_hex & valid(hex_val), _code_point_to_string(hex_val))
        .when(is_dec & valid(dec_val), _code_point_to_string(dec_val))
        .when(~is_hex & ~is_dec, F.element_at(names, body))
    )
    return F.coalesce(decoded, ref)


def decode_entities(c: Column) -> Column:
    """Decode HTML character references in one pass (``&amp;lt;`` -> ``&lt;``).

    Unknown names are left as they are.  Only strings that contain ``&``
    take the array path."""
    names = _named_entity_map()
    refs = F.regexp_extract_all(c, F.lit(ENTITY_PATTERN), 0)
    segs = F.split(c, ENTITY_PATTERN, -1)
    pieces = F.zip_with(segs, refs,
                        lambda s, r: F.concat(F.coalesce(s, F.lit("")),
                                              F.coalesce(_decode_one(r, names), F.lit(""))))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)
