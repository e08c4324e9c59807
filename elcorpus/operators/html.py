"""HTML pages as a table of markup, processed with windows per page.

A page is never parsed into a tree.  It is cut into units in document order
(``posexplode`` of ``regexp_extract_all``): a piece of markup and the text
that follows it, so text needs no rows of its own and rides along.  Before
they become rows, one pass over the page's array makes the nesting explicit
(``balanced``): end tags that HTML lets authors leave out are put in where
the next tag or the end of the parent implies them, and end tags of nothing
open go.  After that every element has its end, and every structural question
becomes a window over ``partitionBy(key).orderBy(seq)``:

* depth        - running count of opens less closes;
* element end  - ``lead(seq)`` over markup of the same depth;
* inside a subtree - running ``max(end)`` of candidate opens: markup at
  ``seq`` is inside if it is >= ``seq``, the text after it if it is > ``seq``;
* enclosing element - running ``max`` of packed (end, seq) (outermost one);
* direct child of the container - depth one below the container's.

The input is hash-partitioned on the page key once, before tokenising; the
Generate and every Window keep that partitioning, so the whole chain runs
with that single Exchange and four sorts: by place, by depth, by place again,
and by heading or formula.  A page is the unit of work: memory per task is
bounded by the largest page, not by the data size.

Limits: mis-nested inline elements end with the outer one and are not
reopened; a formula inside a heading inside a paragraph stays as it is; a page
nested thousands of levels deep costs time by its square.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from elcorpus.functions.strings import decode_entities, py_strip
from elcorpus.functions.titles import is_main_ns_title, is_main_ns_url
from elcorpus.profile import SiteProfile

# FIXED VALUES ---------------------------------------------------------------
# One token: comment, script block, style block, tag, declaration, text run,
# or a lone '<'.  A '>' inside a quoted attribute value does not end a tag.
TOKEN_PATTERN = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
                 r"""|</?[a-z][^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>"""
                 r"|<![^>]*>|[^<]+|<")
# One piece of markup: a token that is not text.
MARKUP_PATTERN = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
                  r"""|</?[a-z][^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>|<![^>]*>""")
# Two code points that are no characters: before a piece of markup, and after it.
BEFORE, AFTER = "\ufdd0", "\ufdd1"
# Elements that never have content.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
             "meta", "param", "source", "track", "wbr")
# Block containers: the end tag of an inline element or a paragraph does not
# reach through them.
BLOCK_TAGS = ("address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd",
              "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
              "header", "html", "li", "main", "nav", "object", "ol", "section", "table", "tbody", "td",
              "tfoot", "th", "thead", "tr", "ul")
# Other tags that mostly stand without attributes.
BARE_TAGS = ("a", "b", "code", "em", "h1", "h2", "h3", "h4", "h5", "h6", "i", "p", "pre", "span", "strong", "sub", "sup", "u")
# Tags whose start closes an open <p>.
P_CLOSERS = ("address", "article", "aside", "blockquote", "center", "dd", "details", "div", "dl",
             "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
             "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section",
             "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
# Start tag -> (elements that it ends, elements at which the search for them stops).
IMPLIED_ENDS = (
    (("li",), ("li",), ("ul", "ol", "menu", "dir", "table", "td", "th")),
    (("dt", "dd"), ("dt", "dd"), ("dl", "table", "td", "th")),
    (("td", "th"), ("td", "th"), ("tr", "tbody", "thead", "tfoot", "table")),
    (("tr",), ("tr",), ("tbody", "thead", "tfoot", "table")),
    (("tbody", "thead", "tfoot"), ("tbody", "thead", "tfoot"), ("table",)),
    (("a",), ("a",), BLOCK_TAGS),
    (P_CLOSERS, ("p",), ("table", "td", "th", "caption", "button", "object")),
)
# End tags -> elements that they do not reach through (others: BLOCK_TAGS).
END_STOPS = (
    (("html", "body", "table"), ()),
    (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), ("table",)),
    (("li",), ("ul", "ol", "table", "td", "th")),
    (("dt", "dd"), ("dl", "table", "td", "th")),
    (tuple(t for t in BLOCK_TAGS + ("pre", "h1", "h2", "h3", "h4", "h5", "h6")
           if t not in ("html", "body", "table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dt", "dd")),
     ("table", "td", "th", "caption")),
)
# Bytes of HTML in one partition; its units take about ten times that to sort.
PARTITION_BYTES = 32 << 20
# -----------------------------------------------------------------------------

_BIG = 2 ** 31 - 1


class _Recorder:
    """Wraps a DataFrame and records the select/filter calls made on it.

    Building the window chain issues thousands of JVM calls to construct
    Column objects; the objects only name columns, so the recorded chain is
    replayed on the next input with the same columns instead of being built
    again (same expressions, a fraction of the planning time)."""

    def __init__(self, df: DataFrame, log: list):
        self.df, self.log = df, log

    @property
    def columns(self):
        return self.df.columns

    def select(self, *cols):
        self.log.append(("select", cols))
        return _Recorder(self.df.select(*cols), self.log)

    def filter(self, cond):
        self.log.append(("filter", (cond,)))
        return _Recorder(self.df.filter(cond), self.log)


_CHAINS: dict = {}


def _replayed(name: str, build, df: DataFrame, *params) -> DataFrame:
    """Run ``build(recorder, *params)`` once per (SparkContext, params,
    input columns); later calls replay the recorded chain on ``df``."""
    from pyspark import SparkContext
    key = (id(SparkContext._active_spark_context), name, params, tuple(df.columns))
    ops = _CHAINS.get(key)
    if ops is None:
        log: list = []
        out = build(_Recorder(df, log), *params).df
        if len(_CHAINS) > 64:
            _CHAINS.clear()
        _CHAINS[key] = log
        return out
    for kind, args in ops:
        df = df.select(*args) if kind == "select" else df.filter(*args)
    return df


def _attr_pattern(name: str) -> str:
    """The first attribute ``name`` of a tag, met by stepping over the
    attributes before it (never inside their values); group 1: its value."""
    value = r"""\s*+=\s*+(%s"[^"]*+"|'[^']*+'|[^\s>]*+)"""
    return (r"(?i)^<[a-z][^\s/>]*+(?:[\s/]++(?!" + name + r"[\s=/>])[^\s=/>]++(?:" + value % "?:" + r")?+)*+[\s/]++"
            + name + r"(?=[\s=/>])(?:" + value % "" + ")?+")


def _attr(tok: Column, name: str, decode: bool = True, bare: bool = False) -> Column:
    """Value of attribute ``name`` of a tag token (null if absent), with
    character references decoded unless ``decode`` is false.  With ``bare``,
    an attribute written without value (``<a title>``) gives ``''``; the
    second pattern only runs when the first found nothing."""
    raw = F.regexp_extract(tok, _attr_pattern(name), 1)
    unq = F.when(raw.rlike(r"""^(?s)(?:".*"|'.*')$"""),
                 F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    out = F.when(raw != "", decode_entities(unq) if decode else unq)
    if bare:
        out = out.when(tok.rlike(_attr_pattern(name)), F.lit(""))
    return out


def _sql_text(s: str) -> str:
    return "r'" + s + "'"


def _one_of(names) -> str:
    return "</(?:" + "|".join(names) + ")>"


#: Tokens whose nesting is followed in one go before the next block of them.
_BLOCK = 512


def _balanced_sql(toks: str, end: str = "") -> str:
    """SQL for the array (of tokens, or of units with ``end`` after their
    markup) with every element's end tag in its place.

    The open elements are kept as the text of the end tags still to come,
    innermost first (``</i></a></p>``).  What stands before an element's own
    end tag is then what has to be put in when it ends.  ``fix`` holds that
    text for each token (null: the token goes); it is gathered in blocks, so
    that appending stays linear."""
    # x: the markup alone; the usual bare tags need no pattern
    bare = ", ".join(f"'<{t}>', '</{t}>'" for t in BLOCK_TAGS + BARE_TAGS)
    mark = (f"case when x in ({bare}) then substring(x, 2, length(x) - 2) "
            "when not startswith(x, '<') or length(x) = 1 then '' when startswith(x, '</') then "
            "lower(regexp_extract(x, '^<(/[a-zA-Z][a-zA-Z0-9:-]*)', 1)) when x rlike "
            + _sql_text("(?i)^<(?:" + "|".join(("script", "style") + VOID_TAGS) + ")(?![a-z0-9:-])")
            + " or instr(x, '/') > 0 and x rlike " + _sql_text(r"/\s*>$") + " then case when x rlike '(?i)^<hr(?![a-z0-9:-])' then '*hr' else '' end "
            "else lower(regexp_extract(x, '^<([a-zA-Z][a-zA-Z0-9:-]*)', 1)) end")
    names = lambda ts: "(" + ", ".join(f"'{t}'" for t in ts) + ")"
    stops = "case " + " ".join(
        f"when substring(m, 2) in {names(tags)} then " + (f"before rlike '{_one_of(stop)}'" if stop else "false")
        for tags, stop in END_STOPS) + f" else before rlike '{_one_of(BLOCK_TAGS)}' end"
    found = []
    for tags, ended, stop in IMPLIED_ENDS:
        stop = [t for t in stop if t not in ended]
        pattern = "^(?:(?!" + _one_of(ended) + "|" + _one_of(stop) + ")</[^>]*+>)*+" + _one_of(ended)
        tags = tuple(tags) + (("*hr",) if "hr" in tags else ())
        open_one = " or ".join(f"instr(acc.stack, '</{t}>') > 0" for t in ended)
        found.append(f"case when m in {names(tags)} and ({open_one}) then nullif(regexp_extract(acc.stack, {_sql_text(pattern)}, 0), '') end")
    found.insert(-1, "case when m in ('h1', 'h2', 'h3', 'h4', 'h5', 'h6') then nullif(regexp_extract(acc.stack, '^</h[1-6]>', 0), '') end")
    plain = [t for t in BARE_TAGS if not any(t in tags for tags, _, _ in IMPLIED_ENDS)]
    ends = f"case when m in {names(plain)} then '' when m = 'p' then coalesce({found[-1]}, '') else coalesce({', '.join(found)}, '') end"
    one = lambda value, var, body: f"transform(array({value}), {var} -> {body})[0]"
    state = lambda stack, fix: f"named_struct('stack', {stack}, 'fix', array_append(acc.fix, {fix}))"
    close = one("instr(acc.stack, concat('<', m, '>'))", "at", one(
        "substring(acc.stack, 1, at - 1)", "before",
        f"case when at = 0 or before <> '' and {stops} then {state('acc.stack', 'cast(null as string)')} "
        f"else {state('substring(acc.stack, at + length(m) + 2)', 'before')} end"))
    start = one(ends, "cl", state("concat(case when startswith(m, '*') then '' else concat('</', m, '>') end, "
                                  "substring(acc.stack, length(cl) + 1))", "cl"))
    # an end tag mostly is that of the innermost element
    step = (f"case when m = '' then {state('acc.stack', chr(39) * 2)} when startswith(m, '/') then "
            f"case when startswith(acc.stack, concat('<', m, '>')) then {state('substring(acc.stack, length(m) + 3)', chr(39) * 2)} else {close} end else {start} end")
    none = "cast(array() as array<string>)"
    block = (f"aggregate(slice(marks, b, {_BLOCK}), named_struct('stack', page.stack, 'fix', {none}), (acc, m) -> {step}, "
             "acc -> named_struct('stack', acc.stack, 'fix', array_append(page.fix, acc.fix)))")
    whole = (f"aggregate(sequence(1, greatest(size(marks), 1), {_BLOCK}), named_struct('stack', '', 'fix', cast(array() as array<array<string>>)), "
             f"(page, b) -> {block}, page -> named_struct('fix', flatten(page.fix), 'rest', page.stack))")
    put_in = f"transform(regexp_extract_all(f, '</[^>]*>', 0), e -> concat(e, '{end}'))"
    after = f"case when instr(x, '{AFTER}') > 0 then substring(x, instr(x, '{AFTER}') + 1) else '' end"  # the text stays when an end tag goes
    merged = (f"concat(flatten(zip_with({toks}, done.fix, (x, f) -> case when f is null then filter(array({after}), t -> t <> '') when f = '' then array(x) "
              f"else concat({put_in}, array(x)) end)), {put_in.replace('(f,', '(done.rest,')})")
    fixed = f"case when done.rest = '' and not exists(done.fix, f -> f is null or f <> '') then {toks} else {merged} end"
    return one(f"transform(transform({toks}, u -> substring_index(u, '{AFTER}', 1)), x -> {mark})", "marks", one(whole, "done", fixed))


def has_class(cls: Column, token: str) -> Column:
    return F.coalesce(cls.rlike(r"(?:^|\s)" + re.escape(token) + r"(?:\s|$)"), F.lit(False))


def is_link_to_article(tag: Column, href: Column, title: Column, profile: SiteProfile) -> Column:
    """A link with a title whose target and title name an article."""
    found = ((tag == "a") & href.startswith(profile.article_path) & title.isNotNull()
             & is_main_ns_title(title, profile) & is_main_ns_url(href, profile))
    return F.coalesce(found, F.lit(False))


def is_dropped_block(tag: Column, cls: Column, profile: SiteProfile) -> Column:
    """A banner, an infobox or an edit link, by its classes."""
    found = F.lit(False)
    for tag_name, token in profile.drop_blocks:
        found = found | (has_class(cls, token) & ((tag == tag_name) if tag_name else F.lit(True)))
    return F.coalesce(found, F.lit(False))


def is_boilerplate_heading(tag: Column, text: Column, profile: SiteProfile) -> Column:
    """A heading whose text names a section that is no content."""
    found = tag.startswith("h") & F.lower(py_strip(text)).isin(*profile.headings)
    return F.coalesce(found, F.lit(False))


def _matches(tag: Column, cls: Column, ident: Column, step) -> Column:
    name, attr, value = step
    cond = tag == name if name else F.lit(True)
    if attr == "class":
        cond = cond & has_class(cls, value)
    elif attr == "id":
        cond = cond & (F.coalesce(ident, F.lit("")) == value)
    return cond


def page_partitions(pages: DataFrame, html: str = "html") -> int:
    """Partitions for the pages: the session's
    ``spark.sql.shuffle.partitions``, or as many as keep the HTML of one at
    about ``PARTITION_BYTES``, so that a task's sorts do not grow with the
    input.  The bytes are counted by a pass over the pages."""
    n_bytes = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    return max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PARTITION_BYTES))


def partition_pages(pages: DataFrame, key: str = "pk", num_partitions: int | None = None, html: str = "html") -> DataFrame:
    """Hash-partition page rows on their key: the one Exchange of the HTML
    chain (every later window and per-page aggregation reuses it).

    The partition count is explicit (default: ``page_partitions``).  The work
    after this Exchange is CPU bound (tokens x window passes), not byte bound,
    so AQE must not coalesce it by shuffle bytes: raw HTML is small relative
    to the work it causes, and byte-based coalescing would fold the whole
    chain into a few tasks."""
    return pages.repartition(num_partitions or page_partitions(pages, html), key)


def tokenize(pages: DataFrame, key: str = "pk", html: str = "html",
             num_partitions: int | None = None, partitioned: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """The balanced units (key, seq, kind, tag, opens, closes, cls, ident,
    href, title, alt, txt), with seq = 0-based document order and ``txt`` the
    text that follows the markup (null if none).
    ``partitioned=True`` when ``pages`` already come from
    ``partition_pages``.  Columns named in ``carry`` are on the page's first
    unit, null on the others; every page then has a unit (an empty document
    an empty text), so that nothing has to be joined back."""
    src = pages.select(key, html, *carry)
    if not partitioned:
        src = partition_pages(src, key, num_partitions, html)
    return _replayed("tokenize", _tokenize_chain, src, key, html, tuple(carry))


def raw_tokens(pages: DataFrame, key: str = "pk", html: str = "html", num_partitions: int | None = None) -> DataFrame:
    """The page's own tokens as they stand, (key, seq, tok, kind, tag):
    markup and text each a row, nothing balanced."""
    src = partition_pages(pages.select(key, html), key, num_partitions, html)
    t = src.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(TOKEN_PATTERN), 0)).alias("seq", "tok"))
    is_markup = F.col("tok").startswith("<") & (F.length("tok") > 1)
    return t.select(key, "seq", "tok", *_kind_and_tag(F.col("tok"), is_markup))


def _kind_and_tag(tok: Column, is_markup: Column) -> tuple[Column, Column]:
    tag = F.when(is_markup, F.lower(F.regexp_extract(tok, r"^</?([a-zA-Z][a-zA-Z0-9:-]*)", 1))).otherwise("")
    kind = (F.when(~is_markup, "text")
            .when(tok.startswith("<!"), "comment")
            .when(tag.isin("script", "style"), "raw")
            .when(tok.startswith("</"), "close")
            .otherwise("open"))
    return kind.alias("kind"), tag.alias("tag")


def _units(html: Column) -> Column:
    """The page cut before every piece of markup; the markup's end is marked.
    The two marks are no characters; a page that has them loses them."""
    page = F.when(html.contains(BEFORE) | html.contains(AFTER), F.translate(html, BEFORE + AFTER, "")).otherwise(html)
    return F.split(F.regexp_replace(page, MARKUP_PATTERN, f"{BEFORE}$0{AFTER}"), BEFORE)


def _tokenize_chain(src, key: str, html: str, carry: tuple[str, ...]):
    t = src.select(key, *carry, _units(F.col(html)).alias("units"))
    units = F.expr(_balanced_sql("units", AFTER))
    each = F.posexplode_outer if carry else F.posexplode
    t = t.select(key, *carry, each(units).alias("seq", "unit"))
    if carry:
        t = t.select(key, F.coalesce("seq", F.lit(0)).alias("seq"), F.coalesce("unit", F.lit("")).alias("unit"),
                     *[F.when(F.coalesce("seq", F.lit(0)) == 0, F.col(c)).alias(c) for c in carry])
    tok = F.when(F.col("unit").contains(AFTER), F.substring_index("unit", AFTER, 1)).otherwise("")
    t = t.select(key, *carry, "seq", tok.alias("tok"), F.nullif(F.substring_index("unit", AFTER, -1), F.lit("")).alias("text"))
    tok = F.col("tok")
    t = t.select(key, *carry, "seq", "tok", "text", *_kind_and_tag(tok, tok != ""))
    is_open_tag = F.col("kind") == "open"
    has_attrs = is_open_tag & (F.length(tok) > F.length("tag") + 2)
    opens = is_open_tag & ~F.col("tag").isin(*VOID_TAGS) & ~tok.endswith("/>") & ~(tok.contains("/") & tok.rlike(r"/\s*>$"))
    # id is only read by container selectors (of any profile): div/article/main/section
    id_tags = ("div", "article", "main", "section", "span", "table")
    return t.select(
        key, "seq", "kind", "tag", *carry,
        opens.alias("opens"),
        (F.col("kind") == "close").alias("closes"),
        F.when(has_attrs, _attr(tok, "class", decode=False)).alias("cls"),
        F.when(has_attrs & F.col("tag").isin(*id_tags), _attr(tok, "id", decode=False)).alias("ident"),
        F.when(has_attrs & (F.col("tag") == "a"), _attr(tok, "href")).alias("href"),
        F.when(has_attrs & (F.col("tag") == "a"), _attr(tok, "title", bare=True)).alias("title"),
        F.when(has_attrs & (F.col("tag") == "img"), _attr(tok, "alt", bare=True)).alias("alt"),
        decode_entities(F.col("text")).alias("txt"),
    )


_SHIFT = 1 << 32


def _pack(hi: Column, lo: Column) -> Column:
    """Two non-negative ints in one long (hi * 2^32 + lo): a running max of
    the pair is then a primitive max (no struct compare or copy per row)."""
    return hi.cast("long") * F.lit(_SHIFT) + lo.cast("long")


def _hi(v: Column) -> Column:
    return F.shiftright(v, 32).cast("int")


def _lo(v: Column) -> Column:
    return (v % F.lit(_SHIFT)).cast("int")


def _outermost(cond: Column, window) -> Column:
    """Running max of (end, seq) over candidate opens, packed in a long: the
    outermost candidate that started at or before this token (enclosing it
    when ``end >= seq``).  Read back with ``_hi`` (end) and ``_lo`` (seq)."""
    return F.max(F.when(cond, _pack(F.col("end"), F.col("seq")))).over(window)


def annotate(tokens: DataFrame, profile: SiteProfile, key: str = "pk", carry: tuple[str, ...] = ()) -> DataFrame:
    """D2-D9 flags on the token table; see ``_annotate_chain``."""
    return _replayed("annotate", _annotate_chain, tokens, profile, key, tuple(carry))


def _annotate_chain(tokens, profile: SiteProfile, key: str, carry: tuple[str, ...]):
    """D2-D9 flags on the units (one row per kept unit).

    A flag of the markup has a twin with ``_t`` for the text after it: that
    text is inside an element that the markup opens and outside one that it
    closes.  Output columns: key, seq, kind, tag, opens, title, href, txt,
    end, page facts (exists C9, has_container D2, qid D12 - carried on every
    row), body/body_t, dropped/dropped_t (D3), cut (D4), live/live_t,
    p_seq/p_index (D5, direct-child paragraph), dc_p (paragraph open),
    kept/kept_t (D6), m_seq/math_text/math_error (D7), link (internal link
    open usable as an edge, D8), l_seq/l_end (outermost internal link, D9),
    and mark/text_piece (what markup and text add to the page's text).

    Units outside the content container are dropped once the page facts are
    known (the first unit of each page stays, carrying them).  Window passes
    whose candidates do not depend on each other share one Window operator;
    subtrees nest, so a candidate inside a removed subtree never encloses a
    kept unit."""
    c = F.col
    run = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    page = Window.partitionBy(key)
    level = Window.partitionBy(key, "lvl").orderBy("seq")
    nsteps = len(profile.container)
    false, none = F.lit(False), F.lit(None).cast("int")

    # -- 0. per-unit flags (each class/tag test evaluated once).
    opens, kind, tag, cls = c("opens"), c("kind"), c("tag"), c("cls")
    flags = [
        F.coalesce(F.array_position(F.array(*[opens & _matches(tag, cls, c("ident"), st) for st in profile.container]),
                                    True), F.lit(0)).alias("cstep"),
    ]
    if profile.drop_blocks:
        flags.append((opens & is_dropped_block(tag, cls, profile)).alias("dropc"))
    if profile.missing_marker:
        mt, mcls = profile.missing_marker
        flags.append(((tag == mt) & (kind == "open") & has_class(cls, mcls)).alias("missing"))
    if profile.qid_href_prefix:
        flags.append(F.when((tag == "a") & (kind == "open") & c("href").startswith(profile.qid_href_prefix),
                            F.struct(c("seq").alias("s"), c("href").alias("h"))).alias("qidc"))
    if profile.math_class:
        flags.append((opens & (tag == "span") & has_class(cls, profile.math_class)).alias("mathc"))
    flags.append((opens & is_link_to_article(tag, c("href"), c("title"), profile)).alias("internal"))
    base = [key, *carry, "seq", "kind", "tag", "opens", "closes", "href", "title", "alt", "txt"]
    t = tokens.select(*base, *flags)

    # -- 1. depth, and element ends: the next markup of the same depth is the
    #    element's own end tag.
    t = t.select("*", F.sum(F.when(opens, 1).when(c("closes"), -1).otherwise(0)).over(run).alias("sd"))
    t = t.select("*", F.when(opens, c("sd")).when(c("closes"), c("sd") + 1).alias("lvl"))
    end = F.when(opens, F.coalesce(F.lead("seq").over(level), F.lit(_BIG))).otherwise(c("seq"))
    t = t.select(*[x for x in t.columns if x not in ("lvl", "closes")], end.alias("end"))

    # -- 2. page facts in one page window: container steps (D2), missing
    #    marker (C9), first wikidata link.
    pf = []
    pf.append((~F.max("missing").over(page)).alias("exists") if profile.missing_marker else F.lit(True).alias("exists"))
    if profile.qid_href_prefix:
        pf.append(F.coalesce(F.substring_index(F.min("qidc").over(page)["h"], "/", -1), F.lit("")).alias("qid"))
    else:
        pf.append(F.lit("").alias("qid"))
    t = t.select(*[x for x in t.columns if x not in ("missing", "qidc")], *pf)
    found = F.lit(None)
    for i in range(1, nsteps + 1):
        cand = c("cstep") == i
        if i > 1:
            cand = cand & (c("seq") > c("_in")["s"]) & (c("seq") < c("_in")["e"])
        found = F.min(F.when(cand, F.struct(c("seq").alias("s"), c("end").alias("e"), c("sd").alias("sd")))).over(page)
        t = t.select(*[x for x in t.columns if x != "_in"], found.alias("_in"))
    body = F.coalesce((c("seq") > c("_in")["s"]) & (c("seq") < c("_in")["e"]), false)
    body_t = F.coalesce((c("seq") >= c("_in")["s"]) & (c("seq") < c("_in")["e"]), false)
    t = t.select(*[x for x in t.columns if x not in ("_in", "cstep")], c("_in")["sd"].alias("c_sd"),
                 c("_in").isNotNull().alias("has_container"), body.alias("body"), body_t.alias("body_t"))
    t = t.filter(c("body_t") | (c("seq") == 0))

    # -- 3. one running window over the body: D3 dropped subtrees, heading
    #    candidates, D5 direct-child paragraphs, D6 footnotes, D7 math spans,
    #    D9 links.  Candidates only need ``body``: whatever lies inside a
    #    dropped subtree or after the cut is masked below (subtrees nest and
    #    the frame only looks back, so later candidates never leak into
    #    earlier units).  A <p> that is itself a drop candidate is never a
    #    paragraph.
    body = c("body")
    dc_p = c("opens") & (c("tag") == "p") & body & (c("sd") == c("c_sd") + 1)
    if profile.drop_blocks:
        dc_p = dc_p & ~c("dropc")
    hd = c("opens") & c("tag").startswith("h") & body
    t = t.select("*", dc_p.alias("dc_p0"))
    rw = [F.max(F.when(c("dc_p0"), _pack(c("seq"), c("end")))).over(run).alias("_p"),
          F.sum(F.when(c("dc_p0"), 1).otherwise(0)).over(run).alias("_pi"),
          F.max(F.when(c("opens") & (c("tag") == "sup") & body, c("end"))).over(run).alias("_sup")]
    if profile.drop_blocks:
        rw.append(F.max(F.when(c("dropc") & body, c("end"))).over(run).alias("_drop"))
    if profile.headings:
        rank = c("tag").rlike("^h[1-6]$")  # inside another h-tag (header, hgroup) it counts for itself
        rw += [_outermost(hd & rank, run).alias("_h"), _outermost(hd & ~rank, run).alias("_ho")]
    if profile.math_class:
        rw.append(_outermost(c("mathc") & body, run).alias("_m"))
    if profile.annotate_links:
        rw.append(_outermost(c("internal") & body, run).alias("_l"))
    t = t.select(*[x for x in t.columns if x not in ("dropc", "mathc")], *rw)

    # what the markup (>=) and the text after it (>) are inside of
    seq = c("seq")
    inside = lambda end: F.coalesce(end >= seq, false)
    inside_t = lambda end: F.coalesce(end > seq, false)
    masks = [(inside(c("_drop")) if profile.drop_blocks else false).alias("dropped"),
             (inside_t(c("_drop")) if profile.drop_blocks else false).alias("dropped_t"),
             (F.coalesce((seq >= _hi(c("_p"))) & (seq < _lo(c("_p"))), false)).alias("_in_p")]
    if profile.headings:
        masks += [F.when(_hi(c("_h")) >= seq, _lo(c("_h"))).when(_hi(c("_ho")) >= seq, _lo(c("_ho"))).alias("h_seq"),
                  (inside_t(_hi(c("_h"))) | inside_t(_hi(c("_ho")))).alias("_h_t")]
    t = t.select(*[x for x in t.columns if x not in ("_drop", "_h", "_ho")], *masks)
    if profile.math_class:
        in_m = body & c("_in_p") & ~c("dropped") & ~inside(c("_sup")) & inside(_hi(c("_m")))
        if profile.headings:
            in_m = in_m & c("h_seq").isNull()
        t = t.select("*", F.when(in_m, _lo(c("_m"))).alias("m_raw"))

    # -- 4. texts of headings and math spans, which never overlap: one window
    #    over both.  D4: the first kept heading whose text is boilerplate.
    #    The alt of the span's first img, else its text up to the LaTeX
    #    marker (without marker the last character is dropped).
    groups = [c(x) for x, on in (("h_seq", profile.headings), ("m_raw", profile.math_class)) if on]
    if groups:
        t = t.select("*", F.coalesce(*groups).alias("_g"))
        group = Window.partitionBy(key, "_g")
        at = c("_g") == seq
        text_in = c("_g").isNotNull() & c("txt").isNotNull() & ~c("dropped_t")
        ends = []
        if profile.headings:
            ends.append(c("h_seq").isNotNull() & c("_h_t"))
        if profile.math_class:
            ends.append(c("m_raw").isNotNull() & inside_t(_hi(c("_m"))) & ~inside_t(c("_sup")))
        in_group = ends[0] if len(ends) == 1 else ends[0] | ends[1]
        piece = F.when(text_in & in_group, F.struct(seq.alias("s"), c("txt").alias("x")))
        got = [F.array_join(F.transform(F.array_sort(F.collect_list(piece).over(group)), lambda x: x["x"]), "").alias("_text")]
        if profile.math_class:
            img = F.when(c("m_raw").isNotNull() & (c("tag") == "img") & (c("kind") == "open"),
                         F.struct(seq.alias("s"), c("alt").isNotNull().alias("has_alt"), c("alt").alias("alt")))
            got.append(F.min(img).over(group).alias("_img"))
        t = t.select("*", *got)
        t = t.select(*[x for x in t.columns if x not in ("_text", "_g", "_h_t")], F.when(at, c("_text")).alias("_text"))
    cut = F.lit(_BIG)
    if profile.headings:
        named = hd & ~c("dropped") & (c("h_seq") == seq) & is_boilerplate_heading(c("tag"), c("_text"), profile)
        cut = F.coalesce(F.min(F.when(named, seq)).over(page), F.lit(_BIG))
    t = t.select(*[x for x in t.columns if x != "h_seq"], cut.alias("cut"))

    # -- 5. masks: live body, paragraph membership, kept units, links.
    t = t.select(*[x for x in t.columns if x not in ("dc_p0", "_sup", "_in_p")],
                 (c("body") & ~c("dropped") & (seq < c("cut"))).alias("live"),
                 (c("body_t") & ~c("dropped_t") & (seq < c("cut"))).alias("live_t"),
                 c("dc_p0").alias("dc_p"), c("_in_p"), inside(c("_sup")).alias("_s"), inside_t(c("_sup")).alias("_st"))
    t = t.select(*[x for x in t.columns if x not in ("dc_p", "_s", "_st")],
                 (c("dc_p") & c("live")).alias("dc_p"),
                 (c("_in_p") & c("live") & ~c("dc_p") & ~c("_s")).alias("kept"),
                 (c("_in_p") & c("live_t") & ~c("_st")).alias("kept_t"))
    in_p = c("_in_p") & (c("live") | c("live_t"))
    t = t.select(*[x for x in t.columns if x not in ("_p", "_pi", "_in_p")],
                 F.when(in_p, _hi(c("_p"))).alias("p_seq"), F.when(in_p, c("_pi")).alias("p_index"))

    # -- 6. math and links of kept units.
    if profile.math_class:
        m_seq = F.when(c("kept"), c("m_raw"))
        is_m = c("kept") & (c("m_raw") == seq)
        plain = F.replace(c("_text"), F.lit("\n"), F.lit(""))
        marker = F.instr(plain, "{\\displaystyle")
        cut_text = (F.when(marker > 0, F.substring(plain, F.lit(1), marker - 1))
                    .otherwise(F.substring(plain, F.lit(1), F.length(plain) - 1)))
        math_text = F.when(is_m, F.when(c("_img").isNotNull(), F.coalesce(c("_img.alt"), F.lit(""))).otherwise(cut_text))
        math_error = F.coalesce(is_m & c("_img").isNotNull() & ~c("_img.has_alt"), false)
        in_math_t = c("m_raw").isNotNull() & inside_t(_hi(c("_m")))
        t = t.select(*[x for x in t.columns if x not in ("_img", "_text", "_m", "m_raw")], m_seq.alias("m_seq"),
                     math_text.alias("math_text"), math_error.alias("math_error"), in_math_t.alias("_mt"))
    else:
        t = t.select(*[x for x in t.columns if x != "_text"], none.alias("m_seq"), F.lit(None).cast("string").alias("math_text"),
                     false.alias("math_error"), false.alias("_mt"))
    if profile.annotate_links:
        in_link = c("kept") & c("m_seq").isNull() & (_hi(c("_l")) >= seq)
        lsel = [F.when(in_link, _lo(c("_l"))).alias("l_seq"), F.when(in_link, _hi(c("_l"))).alias("l_end")]
    else:
        lsel = [none.alias("l_seq"), none.alias("l_end")]
    t = t.select(*[x for x in t.columns if x != "_l"], *lsel, (c("internal") & c("kept")).alias("link"))

    mark = (F.when(c("dc_p"), F.lit("\n"))
            .when(~c("kept"), F.lit(None))
            .when(c("m_seq").isNotNull(), F.when(seq == c("m_seq"), c("math_text")))
            .when(seq == c("l_seq"),
                  F.concat(F.lit("[E="), F.replace(c("title"), F.lit(" "), F.lit("_")), F.lit("]")))
            .when(seq == c("l_end"), F.lit("[/E]")))
    return t.select("*", mark.alias("mark"), F.when(c("kept_t") & ~c("_mt"), c("txt")).alias("text_piece"))


def ordered_text(*pieces: Column) -> Column:
    """The non-null pieces of a group's units, joined in document order."""
    some = F.coalesce(*pieces).isNotNull()
    found = F.when(some, F.struct(F.col("seq").alias("s"), F.concat_ws("", *pieces).alias("x")))
    return F.array_join(F.transform(F.array_sort(F.collect_list(found)), lambda x: x["x"]), "")


def page_results(annotated: DataFrame, profile: SiteProfile, key: str = "pk", carry: tuple[str, ...] = ()) -> DataFrame:
    """D10-D12, C9 per page: exists, qid, has_container, math_error, text, and
    the carried columns.

    One aggregation keyed by the page key (already the partitioning key, so
    no Exchange).  ``text`` = direct-child paragraph texts joined by newline,
    stripped."""
    return annotated.groupBy(key).agg(
        F.max("has_container").alias("has_container"),
        F.max("math_error").alias("math_error"),
        py_strip(ordered_text(F.col("mark"), F.col("text_piece"))).alias("text"),
        F.min("exists").alias("exists"),
        F.min("qid").alias("qid"),
        *[F.first(x, ignorenulls=True).alias(x) for x in carry],
    )


def paragraph_texts(annotated: DataFrame, key: str = "pk") -> DataFrame:
    """D5/D10 per paragraph: (key, p_index, text) for direct-child <p>."""
    p = annotated.filter(F.col("p_index").isNotNull())
    return p.groupBy(key, "p_index").agg(ordered_text(F.when(~F.col("dc_p"), F.col("mark")), F.col("text_piece")).alias("text"))


def link_tokens(annotated: DataFrame, key: str = "pk") -> DataFrame:
    """Internal links in direct-child paragraphs (after D3/D4/D6; math
    is not applied), as (key, seq, target title, href)."""
    return annotated.filter(F.col("link") & F.col("exists")).select(key, "seq", "title", "href")
