"""Title and URL predicates, URL building, cache keys, descriptions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from elcorpus.functions.ascii_fold import to_ascii
from elcorpus.functions.strings import py_strip
from elcorpus.profile import CACHE_KEY_FORBIDDEN, MEDIAWIKI_FR, SiteProfile


def _prefix_regex(prefixes) -> str:
    return "^(?:" + "|".join(re.escape(p) for p in prefixes) + ")"


def is_main_ns_title(title: Column, profile: SiteProfile = MEDIAWIKI_FR) -> Column:
    """True when a title names an article: no ``#`` and no namespace prefix
    (case-insensitive, raw or percent-encoded, with or without colon)."""
    t = F.lower(py_strip(title))
    return ~t.contains("#") & ~t.rlike(_prefix_regex(profile.ns_prefixes))


def is_main_ns_url(url: Column, profile: SiteProfile = MEDIAWIKI_FR) -> Column:
    """True when the part after the first ``/wiki/`` (lower-cased) names an
    article; false when there is no such part."""
    u = F.lower(py_strip(url))
    tail = F.regexp_extract(u, r"(?d)" + re.escape(profile.article_path) + r"(.+)", 1)
    return (tail != "") & is_main_ns_title(tail, profile)


def wikipedia_url(title: Column, profile: SiteProfile = MEDIAWIKI_FR) -> Column:
    """Article URL: spaces become ``_``, percent-encoded keeping ``/``."""
    enc = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return F.concat(F.lit(profile.page_url_prefix), enc)


def cache_key(title: Column) -> Column:
    """File-name key of a title: folded to ASCII, then the forbidden
    characters removed.  Characters without an ASCII form are kept."""
    return F.translate(to_ascii(title), CACHE_KEY_FORBIDDEN, "")


_EXT = {"html": ".html", "txt": ".txt"}
_COMPRESS = {"none": "", "gzip": ".gz", "bz2": ".bz2"}


def cache_path(title: Column, cache_dir: str, kind: str = "html", compress: str = "none") -> Column:
    """``<dir>/frwiki_<key>.<html|txt>[.gz|.bz2]`` for a title."""
    ext = _EXT[kind] + _COMPRESS[compress]
    return F.concat(F.lit(cache_dir.rstrip("/") + "/frwiki_"), cache_key(title), F.lit(ext))


def wikipedia_description(text: Column) -> Column:
    """Text before the first blank line (the whole text if there is none)."""
    return F.substring_index(text, "\n\n", 1)
