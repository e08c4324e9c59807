"""Site profiles and the fixed values that results depend on.

A ``SiteProfile`` collects everything that is specific to one encyclopedia
edition: host, link prefix, namespace names, boilerplate headings, the
selectors of the content container and of the blocks to drop.  Other
editions only need another profile.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote

# ---------------------------------------------------------------------------
# FIXED VALUES - these must stay exactly as written for results to match.
# ---------------------------------------------------------------------------

# Namespace names of the French edition (a title in any of them is not an
# article).  Matched case-insensitively as a prefix, with or without colon.
FR_NAMESPACES = (
    "Média",
    "Spécial",
    "Discussion",
    "Utilisateur",
    "Discussion utilisateur",
    "Wikipédia",
    "Discussion Wikipédia",
    "Fichier",
    "Discussion fichier",
    "MediaWiki",
    "Discussion MediaWiki",
    "Modèle",
    "Discussion modèle",
    "Aide",
    "Discussion aide",
    "Catégorie",
    "Discussion catégorie",
    "Portail",
    "Discussion Portail",
    "Projet",
    "Discussion Projet",
    "Référence",
    "Discussion Référence",
    "Module",
    "Discussion module",
    "Gadget",
    "Discussion gadget",
    "Définition de gadget",
    "Discussion définition de gadget",
    "Sujet",
)

# Section headings from which the rest of an article is dropped.
FR_BOILERPLATE_HEADINGS = (
    "notes et références",
    "notes",
    "annexes",
    "voir aussi",
    "bibliographie",
    "références",
    "liens externes",
)

# Coarse entity types: (type, P31 instance ids, property ids), checked in
# this order; the first rule that holds gives the type, else OTHER.
TYPE_RULES = (
    ("DATE", ("Q73187956", "Q577", "Q14795564"), ("P2894", "P837")),
    ("PERSON", ("Q5", "Q1114461", "Q95074", "Q15632617", "Q15773347", "Q3658341", "Q3375722"),
     ("P1477", "P735", "P21", "P734", "P569")),
    ("GEOLOC", ("Q5119", "Q484170", "Q6465", "Q200250", "Q1200957", "Q3266850"),
     ("P625", "P17", "P30", "P131", "P974", "P200", "P609", "P3896")),
    ("ORG", ("Q1058914", "Q4830453", "Q18388277", "Q891723", "Q249556", "Q43229", "Q3563237",
             "Q155076", "Q6881511", "Q740752", "Q3551775", "Q3918", "Q3591586"),
     ("P452", "P112", "P1454", "P355")),
)
OTHER_TYPE = "OTHER"

# A bullet line of a category listing that names an article.
CATEGORY_LABEL_PATTERN = r"^\*.+?\{\{a-label\|(.+?)\}\}"

# A knowledge-base dump line that holds an item (properties/lexemes differ).
DUMP_ITEM_PATTERN = r'^\{"type":"item","id":"(Q\d+)",'

# Category listing files of good and featured articles (name globs).
CATEGORY_FILE_GLOBS = (
    "Wikipédia_Bons_articles_Justification_de_leur_promotion_2*",
    "Wikipédia_Articles_de_qualité_Justification_de_leur_promotion_2*",
)

# Separator of the aliases column.
ALIAS_SEPARATOR = "::"

# Characters removed from a title to make its cache key.
CACHE_KEY_FORBIDDEN = ":*?/\\\" «»!<>]['"

# ---------------------------------------------------------------------------


def namespace_prefixes(names) -> tuple[str, ...]:
    """Lower-cased prefixes that mark a non-article title or URL tail.

    Each name is lower-cased, spaces become ``_``; its percent-encoded form
    is added.  The colon variants are implied (prefix match), and prefixes
    that start with a shorter prefix are redundant, so the minimal set is
    returned."""
    base = [n.lower().strip().replace(" ", "_") for n in names]
    allp = set(base) | {quote(n).lower() for n in base}
    minimal = sorted(p for p in allp if not any(q != p and p.startswith(q) for q in allp))
    return tuple(minimal)


@dataclass(frozen=True)
class SiteProfile:
    """Edition-specific settings used by the HTML and title operators."""

    name: str
    host: str = "https://fr.wikipedia.org"
    article_path: str = "/wiki/"
    namespaces: tuple[str, ...] = FR_NAMESPACES
    headings: tuple[str, ...] = FR_BOILERPLATE_HEADINGS
    # Content container: nested steps (tag, attribute, token); the first
    # match of each step inside the previous one, in document order.
    container: tuple[tuple[str, str | None, str | None], ...] = (
        ("div", "id", "mw-content-text"), ("div", "class", "mw-parser-output"))
    # Subtrees dropped inside the container: (tag or None, class token).
    drop_blocks: tuple[tuple[str | None, str], ...] = (
        ("span", "mw-editsection"), (None, "bandeau-container"),
        (None, "infobox_v3"), (None, "infobox"))
    # Marker of a page that does not exist: (tag, class token).
    missing_marker: tuple[str, str] | None = ("div", "noarticletext")
    math_class: str | None = "mwe-math-element"
    qid_href_prefix: str | None = "https://www.wikidata.org/wiki/Special:EntityPage/Q"
    language: str = "fr"
    annotate_links: bool = True
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def ns_prefixes(self) -> tuple[str, ...]:
        return namespace_prefixes(self.namespaces)

    @property
    def page_url_prefix(self) -> str:
        return self.host + self.article_path


MEDIAWIKI_FR = SiteProfile(name="mediawiki_fr")

# Generic article pages: paragraphs are the direct <p> children of the
# first <article>; nothing is dropped and no link is internal.
ARTICLE = SiteProfile(
    name="article",
    container=(("article", None, None),),
    drop_blocks=(),
    missing_marker=None,
    math_class=None,
    qid_href_prefix=None,
    headings=(),
    annotate_links=False,
)
