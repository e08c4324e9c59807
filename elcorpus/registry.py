"""Registered queries (Spark) and their independent DuckDB oracles.

Every query reads the driver tables or fixtures derived from them by SQL
(``elcorpus.fixtures``); nothing runs on fixed input alone.  Oracles are
written from the reference semantics with string/regex SQL, not by
translating the Spark plans (the HTML oracle cuts the fixture pages with
regular expressions instead of a token table).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from elcorpus import fixtures as fx
from elcorpus.functions import ascii_fold as FOLD
from elcorpus.functions import strings as S
from elcorpus.functions import titles as T
from elcorpus.functions import wikidata as W
from elcorpus.operators import html as H
from elcorpus.plans import clean as C
from elcorpus.plans import dataset as D
from elcorpus.plans import entities as E
from elcorpus.plans import link_graph as L
from elcorpus.plans import titles as TT
from elcorpus.profile import ARTICLE, FR_BOILERPLATE_HEADINGS, FR_NAMESPACES, MEDIAWIKI_FR, TYPE_RULES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, fixtures=()):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = _with(fixtures, oracle)
        return fn
    return deco


def _with(names, sql: str) -> str:
    names = list(names)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as ({fx.FIXTURES[n]})" for n in names)
    body = sql.lstrip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def _fx(spark, sf, name):
    return fx.fixture(spark, sf, name)


def _tbl(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ----------------------------------------------------------------------------
# SQL building blocks for the oracles
# ----------------------------------------------------------------------------
_NAMES = ", ".join("'" + n.replace("'", "''") + "'" for n in FR_NAMESPACES)
NSL_CTE = f"""nsl as (select list(p) as l from (
  select lower(replace(trim(n), ' ', '_')) as p from (select unnest([{_NAMES}]) as n)
  union select lower(url_encode(lower(replace(trim(n), ' ', '_')))) from (select unnest([{_NAMES}]) as n)))"""


def o_title_ok(t: str) -> str:
    return (f"(not contains(lower(trim({t})), '#') and "
            f"len(list_filter(nsl.l, lambda x: starts_with(lower(trim({t})), x))) = 0)")


def o_url_ok(u: str) -> str:
    tail = f"regexp_extract(lower(trim({u})), '/wiki/(.+)', 1)"
    return f"({tail} <> '' and {o_title_ok(tail)})"


def o_decode(x: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"),
                 ("&copy;", "©"), ("&nbsp;", chr(160)), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def o_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def o_text(x: str) -> str:
    return o_decode(f"regexp_replace({x}, '<[^>]*>', '', 'g')")


# The oracle's own tokeniser (a SQL literal: quotes doubled).
TOK = (r"(?is)<!--.*?-->|<(?:script\b.*?</script|style\b.*?</style)\s*>|</?[a-z](?:\"[^\"]*\"|''[^'']*''|[^\"''>])*>"
       r"|<![^>]*>|[^<]+|<").replace('\\"', '"')
_HEADS = "|".join(FR_BOILERPLATE_HEADINGS)

# Regex cleaner for the wiki_pages fixture (its markup is regular: one
# container closed by '</div></div>', flat banners/infoboxes, one math span
# per paragraph, links written as <a href=".." title="..">..</a>).
CLEAN_O = f"""
{NSL_CTE},
pg as (
  select input_seq, page as title, url, text as html,
    strpos(text, 'class="noarticletext"') = 0 as ex,
    regexp_extract(text, '<a href="https://www\\.wikidata\\.org/wiki/Special:EntityPage/(Q[^"]*)"', 1) as qid0,
    strpos(text, '<div id="mw-content-text">') > 0 and strpos(text, '<div class="mw-parser-output">') > 0 as has_c,
    regexp_extract(text, '(?s)<div class="mw-parser-output">(.*)</div></div>', 1) as body
  from wiki_pages),
dr as (
  select *, regexp_replace(regexp_replace(regexp_replace(body,
      '<span class="mw-editsection">.*?</span>', '', 'g'),
      '<div class="bandeau-container[^"]*">.*?</div>', '', 'g'),
      '<table class="infobox_v3">.*?</table>', '', 'g') as b0
  from pg),
ct as (
  select *, regexp_matches(b0, '(?is)<h[1-6]>\\s*(?:{_HEADS})\\s*</h[1-6]>') as has_cut,
    regexp_replace(b0, '(?is)<h[1-6]>\\s*(?:{_HEADS})\\s*</h[1-6]>.*$', '') as b
  from dr),
pl as (
  select input_seq, regexp_extract_all(b, '(?s)<p>(.*?)</p>', 1) as ps from ct where ex and has_c),
pr as (
  select input_seq, unnest(range(1, len(ps) + 1)) as i, unnest(ps) as p0 from pl),
ps as (
  select input_seq, i, p0, len(regexp_extract_all(p0, '<sup>')) as n_sup,
    regexp_replace(p0, '<sup>.*?</sup>', '', 'g') as p1 from pr),
mm as (
  select *, strpos(p1, '<span class="mwe-math-element">') > 0 as has_m,
    regexp_extract(p1, '(?s)<span class="mwe-math-element">(.*?)</span>', 1) as mc from ps),
mr as (
  select *,
    case when not has_m then null
         when strpos(mc, '<img') > 0 then coalesce(nullif(regexp_extract(mc, '<img[^>]* alt="([^"]*)"', 1), ''), '')
         when strpos(replace(regexp_replace(mc, '<[^>]*>', '', 'g'), chr(10), ''), '{{\\displaystyle') > 0
           then split_part(replace(regexp_replace(mc, '<[^>]*>', '', 'g'), chr(10), ''), '{{\\displaystyle', 1)
         else substr(replace(regexp_replace(mc, '<[^>]*>', '', 'g'), chr(10), ''), 1,
                     length(replace(regexp_replace(mc, '<[^>]*>', '', 'g'), chr(10), '')) - 1) end as math_text,
    has_m and strpos(mc, '<img') > 0 and not regexp_matches(mc, '<img[^>]* alt=') as m_err
  from mm),
lk as (
  select *, case when has_m then replace(p1, '<span class="mwe-math-element">' || mc || '</span>', math_text) else p1 end as p2
  from mr),
lp as (
  select *, regexp_split_to_array(p2, '<a href="[^"]*" title="[^"]*">.*?</a>') as segs,
    regexp_extract_all(p2, '<a href="([^"]*)" title="[^"]*">.*?</a>', 1) as hrefs,
    regexp_extract_all(p2, '<a href="[^"]*" title="([^"]*)">.*?</a>', 1) as titles,
    regexp_extract_all(p2, '<a href="[^"]*" title="[^"]*">(.*?)</a>', 1) as inners
  from lk),
pt as (
  select input_seq, i, n_sup, has_m, math_text, m_err, hrefs, titles,
    len(list_filter(range(1, len(hrefs) + 1), lambda k: starts_with(hrefs[k], '/wiki/') and {o_title_ok('titles[k]')} and {o_url_ok('hrefs[k]')})) as n_marks,
    {o_decode("regexp_replace(array_to_string(list_transform(range(1, len(segs) + 1), lambda k: segs[k] || case when k <= len(hrefs) then (case when starts_with(hrefs[k], '/wiki/') and " + o_title_ok('titles[k]') + " and " + o_url_ok('hrefs[k]') + " then '[E=' || replace(titles[k], ' ', '_') || ']' || inners[k] || '[/E]' else inners[k] end) else '' end), ''), '<[^>]*>', '', 'g')")} as ptxt
  from lp, nsl),
pagetext as (
  select input_seq, {o_strip("string_agg(ptxt, chr(10) order by i)")} as txt, bool_or(m_err) as m_err
  from pt group by input_seq),
rows_o as (
  select g.input_seq, g.title, g.url,
    case when g.ex then g.qid0 else '' end as qid,
    case when g.ex and g.has_c then coalesce(t.txt, '') else '' end as text,
    case when not g.ex then 'ok' when not g.has_c then 'error' when coalesce(t.m_err, false) then 'error' else 'ok' end as status,
    case when not g.ex then null when not g.has_c then 'IndexError' when coalesce(t.m_err, false) then 'KeyError' end as error_class,
    case when not g.ex then null when not g.has_c then 'list index out of range' when coalesce(t.m_err, false) then '''alt''' end as message
  from pg g left join pagetext t on t.input_seq = g.input_seq),
firsts as (
  select title, min(input_seq) as first_ok from rows_o where status = 'ok' group by title),
cleaned_o as (
  select r.title, r.url, r.qid, r.text, r.input_seq from rows_o r join firsts f on f.title = r.title and f.first_ok = r.input_seq)
"""

GOOD_O = """good_o as (
  select distinct replace(regexp_replace(regexp_extract(value, '^\\*.+?\\{\\{a-label\\|(.+?)\\}\\}', 1), '^\\s+|\\s+$', '', 'g'), ' ', '_') as title
  from category_lines where regexp_matches(value, '^\\*.+?\\{\\{a-label\\|(.+?)\\}\\}'))"""

DUMP_O = """dl as (
  select regexp_replace(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), ',$', '') as line from wikidata_dump
  where regexp_replace(value, '^\\s+|\\s+$', '', 'g') not in ('[', ']', '')),
items_o as (
  select regexp_extract(line, '^\\{"type":"item","id":"(Q\\d+)",', 1) as qid, line from dl
  where regexp_extract(line, '^\\{"type":"item","id":"(Q\\d+)",', 1) <> ''),
uitems_o as (select qid, min(line) as line from items_o group by qid)"""


def o_features(src: str) -> str:
    """Oracle features of (qid, line) rows in ``src``."""
    ids = ("list_transform(coalesce(json_extract(line, '$.claims.P31[*]'), []), "
           "lambda c: json_extract_string(c, '$.mainsnak.datavalue.value.id'))")
    flags = []
    for name, inst, props in TYPE_RULES:
        il = "[" + ", ".join(f"'{i}'" for i in inst) + "]"
        pl = "[" + ", ".join(f"'{p}'" for p in props) + "]"
        hit = f"coalesce(list_position(list_transform(ids, lambda x: coalesce(list_contains({il}, x), false)), true), 0)"
        bad = "coalesce(list_position(list_transform(ids, lambda x: x is null), true), 0)"
        flags.append(f"({hit} > 0 and ({bad} = 0 or {hit} < {bad})) as inst_{name.lower()}")
        flags.append(f"coalesce(list_has_any(coalesce(json_keys(json_extract(line, '$.claims')), []), {pl}), false) as prop_{name.lower()}")
    return f"""feat0 as (select qid, line, {ids} as ids from {src}),
feat_o as (
  select qid,
    coalesce(json_extract_string(line, '$.descriptions.fr.value'), '') as wikidata_description,
    coalesce(json_extract_string(line, '$.labels.fr.value'), '') as label,
    array_to_string(coalesce(json_extract_string(line, '$.aliases.fr[*].value'), []), '::') as aliases,
    {", ".join(flags)}
  from feat0),
typed_o as (
  select *, case when inst_date or prop_date then 'DATE' when inst_person or prop_person then 'PERSON'
    when inst_geoloc or prop_geoloc then 'GEOLOC' when inst_org or prop_org then 'ORG' else 'OTHER' end as type
  from feat_o)"""


# ----------------------------------------------------------------------------
# J1 titles and scalar title/URL functions
# ----------------------------------------------------------------------------
@query("good_titles", f"with {GOOD_O} select title from good_o", ["category_lines"])
def q_good_titles(spark, sf):
    return TT.good_titles(_fx(spark, sf, "category_lines"))


@query("normalize_titles",
       "select id, replace(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), ' ', '_') as title from title_inputs",
       ["title_inputs"])
def q_normalize_titles(spark, sf):
    t = _fx(spark, sf, "title_inputs")
    return t.select("id", S.normalize_title(F.col("title")).alias("title"))


@query("main_ns_titles", f"with {NSL_CTE} select id, title from title_inputs, nsl where {o_title_ok('title')}",
       ["title_inputs"])
def q_main_ns_titles(spark, sf):
    t = _fx(spark, sf, "title_inputs")
    return t.filter(T.is_main_ns_title(F.col("title"))).select("id", "title")


@query("main_ns_urls", f"with {NSL_CTE} select id, url from url_inputs, nsl where {o_url_ok('url')}",
       ["url_inputs"])
def q_main_ns_urls(spark, sf):
    u = _fx(spark, sf, "url_inputs")
    return u.filter(T.is_main_ns_url(F.col("url"))).select("id", "url")


@query("page_urls",
       "select id, 'https://fr.wikipedia.org/wiki/' || replace(url_encode(replace(title, ' ', '_')), '%2F', '/') as url from title_inputs",
       ["title_inputs"])
def q_page_urls(spark, sf):
    t = _fx(spark, sf, "title_inputs")
    return t.select("id", T.wikipedia_url(F.col("title")).alias("url"))


def _o_ascii(x: str) -> str:
    """ASCII form in SQL: fixed letters by replacement, the rest by removing
    accents; the fixture's words of other scripts as they must come out."""
    words = (("서울", "seoul"), ("한국어", "hangugeo"), ("さくら", "sakura"), ("カタカナ", "katakana"), ("Ⅷ ½ ﬁn Ａｂ", "VIII 1/2 fin Ab"))
    fixed = FOLD.LATIN | FOLD.SIGNS | {c: r for t in (FOLD.GREEK, FOLD.CYRILLIC) for c, r in t.items()}
    fixed |= {c.upper(): r.capitalize() for t in (FOLD.GREEK, FOLD.CYRILLIC) for c, r in t.items() if c != "ς" and r[0].isalpha()}
    sql = lambda v: "'" + v.replace("'", "''") + "'"
    before = [(c, r) for c, r in fixed.items() if c in "ёЁїЇґҐўЎѓЃќЌ"]  # these would lose their marks
    after = [(c, r) for c, r in fixed.items() if len(r) == 1]
    many = [(c, r) for c, r in fixed.items() if len(r) != 1]
    for a, b in (*words, *before):
        x = f"replace({x}, {sql(a)}, {sql(b)})"
    x = f"translate(strip_accents({x}), {sql(''.join(c for c, _ in after))}, {sql(''.join(r for _, r in after))})"
    for a, b in many:
        x = f"replace({x}, {sql(a)}, {sql(b)})"
    return x


_O_KEY = f"regexp_replace({_o_ascii('title')}, '[:*?/\\\\\" «»!<>\\]\\[''\"]', '', 'g')"


@query("cache_key", f"select id, {_O_KEY} as key from title_inputs", ["title_inputs"])
def q_cache_key(spark, sf):
    t = _fx(spark, sf, "title_inputs")
    return t.select("id", T.cache_key(F.col("title")).alias("key"))


@query("cache_paths",
       f"select id, '/cache/frwiki_' || {_O_KEY} || '.html.gz' as html_path, '/cache/frwiki_' || {_O_KEY} || '.txt' as txt_path from title_inputs",
       ["title_inputs"])
def q_cache_paths(spark, sf):
    t = _fx(spark, sf, "title_inputs")
    return t.select("id", T.cache_path(F.col("title"), "/cache", "html", "gzip").alias("html_path"),
                    T.cache_path(F.col("title"), "/cache", "txt", "none").alias("txt_path"))


@query("cache_key_collisions",
       f"select key, count(*) as n_titles from (select distinct {_O_KEY} as key, title from title_inputs) group by key having count(*) > 1",
       ["title_inputs"])
def q_cache_key_collisions(spark, sf):
    return L.cache_key_collisions(_fx(spark, sf, "title_inputs"))


@query("wikipedia_description",
       "select doc_id, split_part(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10), 1) as first_line, "
       "split_part(text, chr(10) || chr(10), 1) as whole from documents")
def q_wikipedia_description(spark, sf):
    d = _tbl(spark, sf, "documents")
    return d.select("doc_id", T.wikipedia_description(F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))).alias("first_line"),
                    T.wikipedia_description(F.col("text")).alias("whole"))


@query("decode_entities", f"select page_id, {o_decode('html')} as text from pages")
def q_decode_entities(spark, sf):
    p = _tbl(spark, sf, "pages")
    return p.select("page_id", S.decode_entities(F.col("html")).alias("text"))


# ----------------------------------------------------------------------------
# J5 knowledge-base features
# ----------------------------------------------------------------------------
def _items(spark, sf):
    return E.dump_items(E.dump_lines(_fx(spark, sf, "wikidata_dump")))


def _uitems(spark, sf):
    return _items(spark, sf).groupBy("qid").agg(F.min("line").alias("line"))


@query("dump_qids", f"with {DUMP_O} select qid, line from items_o", ["wikidata_dump"])
def q_dump_qids(spark, sf):
    return _items(spark, sf)


@query("entity_labels", f"with {DUMP_O}, {o_features('uitems_o')} select qid, label, wikidata_description from typed_o",
       ["wikidata_dump"])
def q_entity_labels(spark, sf):
    f = E.features(_uitems(spark, sf))
    return f.select("qid", "label", "wikidata_description")


@query("entity_aliases", f"with {DUMP_O}, {o_features('uitems_o')} select qid, aliases from typed_o", ["wikidata_dump"])
def q_entity_aliases(spark, sf):
    return E.features(_uitems(spark, sf)).select("qid", "aliases")


def _flag_query(spark, sf, kind):
    it = _uitems(spark, sf).select("qid", W.parse_item(F.col("line")).alias("it"))
    it = it.select("qid", "it", W.p31_ids(F.col("it")).alias("ids"))
    cols = []
    for name, inst, props in TYPE_RULES:
        if kind in ("inst", "both"):
            cols.append(W.is_instance_of(F.col("ids"), inst).alias(f"inst_{name.lower()}"))
        if kind in ("prop", "both"):
            cols.append(W.has_property(F.col("it"), props).alias(f"prop_{name.lower()}"))
    return it.select("qid", *cols)


_TYPES = [n.lower() for n, _, _ in TYPE_RULES]


@query("instance_of", f"with {DUMP_O}, {o_features('uitems_o')} select qid, " + ", ".join(f"inst_{t}" for t in _TYPES) + " from typed_o",
       ["wikidata_dump"])
def q_instance_of(spark, sf):
    return _flag_query(spark, sf, "inst")


@query("has_property", f"with {DUMP_O}, {o_features('uitems_o')} select qid, " + ", ".join(f"prop_{t}" for t in _TYPES) + " from typed_o",
       ["wikidata_dump"])
def q_has_property(spark, sf):
    return _flag_query(spark, sf, "prop")


@query("type_flags", f"with {DUMP_O}, {o_features('uitems_o')} select qid, " + ", ".join(f"(inst_{t} or prop_{t}) as is_{t}" for t in _TYPES) + " from typed_o",
       ["wikidata_dump"])
def q_type_flags(spark, sf):
    f = _flag_query(spark, sf, "both")
    return f.select("qid", *[(F.col(f"inst_{t}") | F.col(f"prop_{t}")).alias(f"is_{t}") for t in _TYPES])


@query("last_write_wins", """
select input_seq, page, url, text from wiki_pages
qualify row_number() over (partition by page order by input_seq desc) = 1""", ["wiki_pages"])
def q_last_write_wins(spark, sf):
    return D.last_write_wins(_fx(spark, sf, "wiki_pages"), key="page").select("input_seq", "page", "url", "text")


@query("entity_types", f"with {DUMP_O}, {o_features('uitems_o')} select qid, type from typed_o", ["wikidata_dump"])
def q_entity_types(spark, sf):
    return E.features(_uitems(spark, sf)).select("qid", "type")


# ----------------------------------------------------------------------------
# D1-D12 HTML operators
# ----------------------------------------------------------------------------
def _driver_pages(spark, sf):
    return _tbl(spark, sf, "pages").select(F.col("page_id").alias("pk"), F.col("html"))


@query("html_tokens", f"""
with tk as (select page_id, regexp_extract_all(html, '{TOK}') as toks from pages),
t as (select page_id, unnest(range(0, len(toks))) as seq, unnest(toks) as tok from tk)
select page_id, seq, tok,
  case when not (starts_with(tok, '<') and length(tok) > 1) then 'text'
       when starts_with(tok, '<!') then 'comment'
       when lower(regexp_extract(tok, '^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1)) in ('script', 'style') then 'raw'
       when starts_with(tok, '</') then 'close' else 'open' end as kind,
  case when starts_with(tok, '<') and length(tok) > 1 then lower(regexp_extract(tok, '^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1)) else '' end as tag
from t""")
def q_html_tokens(spark, sf):
    t = H.raw_tokens(_driver_pages(spark, sf))
    return t.select(F.col("pk").alias("page_id"), F.col("seq").cast("bigint").alias("seq"), "tok", "kind", "tag")


@query("paragraphs", f"""
with a as (select page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) as art from pages),
s as (select page_id, regexp_split_to_array(art, '<p>') as parts from a),
u as (select page_id, unnest(range(1, len(parts))) as p_index, unnest(parts[2:]) as part from s)
select page_id, p_index,
  {o_decode("regexp_replace(regexp_extract(part, '(?s)^(.*?)(?:</p>|<h[1-6][ >]|$)', 1), '<[^>]*>', '', 'g')")} as text
from u""")
def q_paragraphs(spark, sf):
    ann = H.annotate(H.tokenize(_driver_pages(spark, sf)), ARTICLE)
    return H.paragraph_texts(ann).select(F.col("pk").alias("page_id"), "p_index", "text")


def _wiki_annotated(spark, sf, profile=MEDIAWIKI_FR):
    wp = _fx(spark, sf, "wiki_pages")
    toks = H.tokenize(wp.select(F.col("input_seq").alias("pk"), F.col("text").alias("html")))
    return H.annotate(toks, profile)


def _text_where(cond):
    """The text of a page's (paragraph's) units that meets ``cond``."""
    return H.ordered_text(F.when(cond, F.col("txt"))).alias("text")


def _n_tokens(markup, text):
    """Pieces of markup and of text that meet their condition."""
    return F.count(F.when(markup & (F.col("kind") != "text"), 1)) + F.count(F.when(text & F.col("txt").isNotNull(), 1))


@query("container_scope", f"""
with {CLEAN_O}
select input_seq, has_c as has_container,
  case when has_c then len(regexp_extract_all(body, '{TOK}')) else 0 end as n_body_tokens from pg""", ["wiki_pages"])
def q_container_scope(spark, sf):
    a = _wiki_annotated(spark, sf)
    return a.groupBy(F.col("pk").alias("input_seq")).agg(
        F.max("has_container").alias("has_container"),
        _n_tokens(F.col("body"), F.col("body_t")).alias("n_body_tokens"))


@query("strip_boilerplate", f"""
with {CLEAN_O}
select input_seq, coalesce(list_sum(list_transform(regexp_extract_all(body,
  '<span class="mw-editsection">.*?</span>|<div class="bandeau-container[^"]*">.*?</div>|<table class="infobox_v3">.*?</table>'),
  lambda b: len(regexp_extract_all(b, '{TOK}')))), 0) as n_dropped, {o_text('b0')} as text
from dr where has_c""", ["wiki_pages"])
def q_strip_boilerplate(spark, sf):
    a = _wiki_annotated(spark, sf)
    return (a.groupBy(F.col("pk").alias("input_seq"))
            .agg(F.max("has_container").alias("hc"), _n_tokens(F.col("dropped"), F.col("dropped_t")).alias("n_dropped"),
                 _text_where(F.col("body_t") & ~F.col("dropped_t")))
            .filter("hc").drop("hc"))


@query("cut_sections", f"with {CLEAN_O} select input_seq, has_cut, {o_text('b')} as text from ct where has_c", ["wiki_pages"])
def q_cut_sections(spark, sf):
    a = _wiki_annotated(spark, sf)
    return (a.groupBy(F.col("pk").alias("input_seq"))
            .agg(F.max("has_container").alias("hc"), F.max(F.col("cut") < H._BIG).alias("has_cut"), _text_where(F.col("live_t")))
            .filter("hc").drop("hc"))


@query("drop_footnotes", f"with {CLEAN_O} select input_seq, i as p_index, n_sup, {o_text('p1')} as text from ps", ["wiki_pages"])
def q_drop_footnotes(spark, sf):
    a = _wiki_annotated(spark, sf).filter(F.col("p_index").isNotNull() & F.col("exists"))
    return (a.groupBy(F.col("pk").alias("input_seq"), "p_index")
            .agg(F.count(F.when(F.col("opens") & (F.col("tag") == "sup") & ~F.col("dc_p") & F.col("live"), 1)).alias("n_sup"),
                 _text_where(F.col("kept_t"))))


@query("math_to_text", f"with {CLEAN_O} select input_seq, i as p_index, math_text, m_err as math_error from mr where has_m",
       ["wiki_pages"])
def q_math_to_text(spark, sf):
    a = _wiki_annotated(spark, sf).filter(F.col("exists") & (F.col("seq") == F.col("m_seq")))
    return a.select(F.col("pk").alias("input_seq"), "p_index", "math_text", "math_error")


@query("link_edges", f"""
with {CLEAN_O},
lk0 as (select input_seq, regexp_extract_all(p1, '<a href="([^"]*)" title="[^"]*">', 1) as hrefs,
               regexp_extract_all(p1, '<a href="[^"]*" title="([^"]*)">', 1) as titles from ps),
lk1 as (select input_seq, unnest(hrefs) as href, unnest(titles) as title from lk0)
select input_seq, replace(title, ' ', '_') as page, 'https://fr.wikipedia.org' || href as url
from lk1, nsl where starts_with(href, '/wiki/') and {o_title_ok('title')} and {o_url_ok('href')}""", ["wiki_pages"])
def q_link_edges(spark, sf):
    links = H.link_tokens(_wiki_annotated(spark, sf))
    return links.select(F.col("pk").alias("input_seq"), F.replace(F.col("title"), F.lit(" "), F.lit("_")).alias("page"),
                        F.concat(F.lit(MEDIAWIKI_FR.host), F.col("href")).alias("url"))


@query("annotate_links", f"with {CLEAN_O} select input_seq, i as p_index, n_marks, ptxt as text from pt", ["wiki_pages"])
def q_annotate_links(spark, sf):
    a = _wiki_annotated(spark, sf).filter(F.col("p_index").isNotNull() & F.col("exists"))
    return (a.groupBy(F.col("pk").alias("input_seq"), "p_index")
            .agg(F.count(F.when(F.col("seq") == F.col("l_seq"), 1)).alias("n_marks"),
                 H.ordered_text(F.when(~F.col("dc_p"), F.col("mark")), F.col("text_piece")).alias("text")))


@query("page_qid", f"with {CLEAN_O} select input_seq, case when ex then qid0 else '' end as qid from pg", ["wiki_pages"])
def q_page_qid(spark, sf):
    res = H.page_results(_wiki_annotated(spark, sf), MEDIAWIKI_FR)
    return res.select(F.col("pk").alias("input_seq"), F.when(F.col("exists"), F.col("qid")).otherwise("").alias("qid"))


@query("page_exists", f"with {CLEAN_O} select input_seq, ex as exists from pg", ["wiki_pages"])
def q_page_exists(spark, sf):
    res = H.page_results(_wiki_annotated(spark, sf), MEDIAWIKI_FR)
    return res.select(F.col("pk").alias("input_seq"), "exists")


# ----------------------------------------------------------------------------
# J4 cleaning
# ----------------------------------------------------------------------------
@query("clean_text", f"with {CLEAN_O} select input_seq, title, url, qid, text, status, error_class, message from rows_o",
       ["wiki_pages"])
def q_clean_text(spark, sf):
    return C.cleaned_rows(_fx(spark, sf, "wiki_pages")).drop("row_key")


@query("clean_repeated_ids", f"""with {CLEAN_O}
select input_seq % 7 as input_seq, title, url, qid, text, status, error_class, message from rows_o""", ["wiki_pages"])
def q_clean_repeated_ids(spark, sf):
    """Records that share their ids with many others; no page is lost
    or mixed with another."""
    from elcorpus.sources import read_html_pages
    path = _scratch(spark, "repeated_ids")
    _fx(spark, sf, "wiki_pages").withColumn("input_seq", F.col("input_seq") % 7).write.json(path)
    return C.cleaned_rows(read_html_pages(spark, path)).drop("row_key")


@query("clean_pages", f"with {CLEAN_O} select title, url, qid, text from cleaned_o", ["wiki_pages"])
def q_clean_pages(spark, sf):
    return C.clean_pages(_fx(spark, sf, "wiki_pages"))[0]


@query("first_clean_per_title", f"with {CLEAN_O} select title, input_seq from cleaned_o", ["wiki_pages"])
def q_first_clean_per_title(spark, sf):
    from elcorpus.session import ensure_checkpoint_dir, materialize
    ensure_checkpoint_dir(spark)
    rows = materialize(C.cleaned_rows(_fx(spark, sf, "wiki_pages")), "clean-rows")
    return C.first_clean_per_title(rows).select("title", "input_seq")


@query("clean_errors", f"""with {CLEAN_O}
select r.input_seq, r.title, r.url, r.error_class, r.message from rows_o r left join firsts f on f.title = r.title
where r.status = 'error' and (f.first_ok is null or r.input_seq < f.first_ok)""", ["wiki_pages"])
def q_clean_errors(spark, sf):
    return C.clean_pages(_fx(spark, sf, "wiki_pages"))[1]


def _already(spark, sf):
    lab = _tbl(spark, sf, "labels")
    return lab.filter(F.col("quality") == 1).select(F.concat(F.lit("Doc_"), F.col("doc_id").cast("string")).alias("title"))


@query("resume_clean", f"""with {CLEAN_O},
done as (select 'Doc_' || cast(doc_id as varchar) as title from labels where quality = 1),
r2 as (select * from rows_o where title not in (select title from done)),
f2 as (select title, min(input_seq) as first_ok from r2 where status = 'ok' group by title)
select r.title, r.url, r.qid, r.text from r2 r join f2 f on f.title = r.title and f.first_ok = r.input_seq""", ["wiki_pages"])
def q_resume_clean(spark, sf):
    return C.clean_pages(_fx(spark, sf, "wiki_pages"), already=_already(spark, sf))[0]


# ----------------------------------------------------------------------------
# J2/J3 link graph and frontier
# ----------------------------------------------------------------------------
LINKS_O = f"""{GOOD_O},
{CLEAN_O},
seedp as (select g.title, min(w.input_seq) as input_seq from good_o g join wiki_pages w on w.page = g.title group by g.title),
sedges as (
  select s.title as linked_from, e.href, e.ltitle from seedp s join (
    select input_seq, unnest(regexp_extract_all(p1, '<a href="([^"]*)" title="[^"]*">', 1)) as href,
                      unnest(regexp_extract_all(p1, '<a href="[^"]*" title="([^"]*)">', 1)) as ltitle from ps) e
  on e.input_seq = s.input_seq, nsl
  where starts_with(e.href, '/wiki/') and {o_title_ok('e.ltitle')} and {o_url_ok('e.href')}),
links_o as (
  select title as page, '' as linked_from, 'https://fr.wikipedia.org/wiki/' || replace(url_encode(replace(title, ' ', '_')), '%2F', '/') as url from good_o
  union all
  select replace(ltitle, ' ', '_') as page, linked_from, 'https://fr.wikipedia.org' || href as url from sedges)"""


def _links(spark, sf):
    good = TT.good_titles(_fx(spark, sf, "category_lines"))
    return L.link_graph(good, _fx(spark, sf, "wiki_pages"))


@query("seed_pages", f"with {LINKS_O} select title, input_seq from seedp", ["category_lines", "wiki_pages"])
def q_seed_pages(spark, sf):
    good = TT.good_titles(_fx(spark, sf, "category_lines"))
    return L.seed_pages(good, _fx(spark, sf, "wiki_pages")).select("title", "input_seq")


@query("page_links", f"with {LINKS_O} select page, linked_from, url from links_o", ["category_lines", "wiki_pages"])
def q_page_links(spark, sf):
    return _links(spark, sf)


@query("all_pages", f"with {LINKS_O} select distinct page from links_o", ["category_lines", "wiki_pages"])
def q_all_pages(spark, sf):
    return L.all_pages(_links(spark, sf))


@query("frontier_distinct", f"with {LINKS_O} select distinct page, url from links_o", ["category_lines", "wiki_pages"])
def q_frontier_distinct(spark, sf):
    return L.frontier_distinct(_links(spark, sf))




@query("fetch_frontier", f"""with {LINKS_O},
cached as (select distinct replace(page, ' ', '_') as page from wiki_pages where page is not null and input_seq in (select doc_id from labels))
select distinct page, url from links_o where page not in (select page from cached)""", ["category_lines", "wiki_pages"])
def q_fetch_frontier(spark, sf):
    # The HTML cache holds the pages of the labelled documents so far.
    wp = _fx(spark, sf, "wiki_pages")
    cached = wp.join(_tbl(spark, sf, "labels").select(F.col("doc_id").alias("input_seq")), "input_seq", "left_semi")
    return L.fetch_frontier(_links(spark, sf), cached.select("page"))


# ----------------------------------------------------------------------------
# J5 on cleaned pages, J6 final tables
# ----------------------------------------------------------------------------
def _cleaned(spark, sf):
    """The cleaned-pages stage, written once in the checkpoint folder: it
    survives executor loss, and later stages read it as often as they need."""
    from elcorpus.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    from elcorpus.session import materialize
    return materialize(C.clean_pages(_fx(spark, sf, "wiki_pages"))[0], "cleaned")


ENT_O = f"""{CLEAN_O},
{DUMP_O},
wanted_o as (select qid, min(line) as line from items_o where qid in (select qid from cleaned_o where qid <> '') group by qid),
{o_features('wanted_o')}"""


@query("dump_semi_join", f"with {ENT_O} select qid from wanted_o", ["wiki_pages", "wikidata_dump"])
def q_dump_semi_join(spark, sf):
    items = _items(spark, sf)
    return E.wanted_items(items, E.known_qids(_cleaned(spark, sf))).select("qid")


@query("entity_features", f"with {ENT_O} select qid, wikidata_description, label, aliases, type from typed_o",
       ["wiki_pages", "wikidata_dump"])
def q_entity_features(spark, sf):
    return E.entity_features(_fx(spark, sf, "wikidata_dump"), _cleaned(spark, sf))


@query("corpus", f"with {GOOD_O}, {CLEAN_O} select c.title, c.qid, c.text from cleaned_o c where c.title in (select title from good_o)",
       ["category_lines", "wiki_pages"])
def q_corpus(spark, sf):
    good = TT.good_titles(_fx(spark, sf, "category_lines"))
    return D.corpus(good, _cleaned(spark, sf))


ENTITIES_O = f"""with {ENT_O}
select c.qid, c.title, c.url, split_part(c.text, chr(10) || chr(10), 1) as wikipedia_description,
  t.wikidata_description, t.label, t.aliases, t.type
from cleaned_o c left join typed_o t on t.qid = c.qid and c.qid <> ''"""


def entities_query(spark, sf):
    cleaned = _cleaned(spark, sf)
    from elcorpus.session import materialize
    wd = materialize(E.entity_features(_fx(spark, sf, "wikidata_dump"), cleaned), "wikidata")
    return D.entities(cleaned, wd)


query("entities", ENTITIES_O, ["wiki_pages", "wikidata_dump"])(entities_query)


# ----------------------------------------------------------------------------
# Sources and sinks: derived data is written under the session's checkpoint
# folder and read back with the library readers.
# ----------------------------------------------------------------------------
def _scratch(spark, name):
    from elcorpus.session import ensure_checkpoint_dir, stage_path
    ensure_checkpoint_dir(spark)
    return stage_path(spark, name)


def _place_parts(spark, src_dir: str, dst_dir: str, name: str) -> None:
    """Move the part files Spark wrote into ``src_dir`` to ``dst_dir``
    under a chosen file name (listing files have fixed names)."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(dst_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(dst_dir))
    for i, st in enumerate(sorted(fs.listStatus(Path(src_dir)), key=lambda x: x.getPath().getName())):
        if st.getPath().getName().startswith("part-"):
            fs.rename(st.getPath(), Path(f"{dst_dir}/{name}_{i}.txt"))


@query("scan_category_lines", "select value from category_lines", ["category_lines"])
def q_scan_category_lines(spark, sf):
    """A1 over listing files: lines split over one file per category kind
    (names matching the globs) plus a decoy file that must be ignored."""
    from elcorpus.profile import CATEGORY_FILE_GLOBS
    from elcorpus.sources import read_category_lines
    base = _scratch(spark, "categories")
    lines = _fx(spark, sf, "category_lines")
    half = F.pmod(F.hash("value"), F.lit(2))
    for k, glob in enumerate(CATEGORY_FILE_GLOBS):
        lines.filter(half == k).write.text(f"{base}/w{k}")
        _place_parts(spark, f"{base}/w{k}", f"{base}/listing", glob.replace("_2*", "_2021"))
    spark.createDataFrame([("* decoy {{a-label|Decoy}}",)], "value string").write.text(f"{base}/wd")
    _place_parts(spark, f"{base}/wd", f"{base}/listing", "Autre_liste_2021")
    return read_category_lines(spark, f"{base}/listing")


@query("sorted_title_file", f"with {GOOD_O} select title, row_number() over (order by title) as place from good_o", ["category_lines"])
def q_sorted_title_file(spark, sf):
    """The sorted title file read back with the place of each line."""
    from elcorpus.sinks import write_sorted_titles
    from elcorpus.sources import read_lines_in_order
    path = _scratch(spark, "good_titles")
    write_sorted_titles(TT.good_titles(_fx(spark, sf, "category_lines")), path)
    return read_lines_in_order(spark, path).withColumnRenamed("value", "title")


@query("scan_title_list",
       "select distinct replace(regexp_replace(regexp_extract(value, '\\{\\{a-label\\|(.+?)\\}\\}', 1), '^\\s+|\\s+$', '', 'g'), ' ', '_') as title "
       "from category_lines where regexp_matches(value, '\\{\\{a-label\\|(.+?)\\}\\}') "
       "and regexp_replace(regexp_extract(value, '\\{\\{a-label\\|(.+?)\\}\\}', 1), '\\s', '', 'g') <> ''",
       ["category_lines"])
def q_scan_title_list(spark, sf):
    from elcorpus.sources import read_title_list
    path = _scratch(spark, "title_list")
    lab = _fx(spark, sf, "category_lines").select(F.regexp_extract("value", r"\{\{a-label\|(.+?)\}\}", 1).alias("v"))
    # raw labels with spaces, plus blank lines, as a plain title file
    lab.select(F.when(F.col("v") == "", F.lit("   ")).otherwise(F.concat(F.lit(" "), F.col("v"), F.lit(" "))).alias("value")) \
       .write.text(path)
    return read_title_list(spark, path, normalize=True)


@query("scan_csv_strings", f"with {LINKS_O} select page, linked_from, url from links_o", ["category_lines", "wiki_pages"])
def q_scan_csv_strings(spark, sf):
    from elcorpus.sinks import write_csv_quoted
    from elcorpus.sources import read_csv_strings
    path = _scratch(spark, "page_links_csv")
    write_csv_quoted(_links(spark, sf), path)
    return read_csv_strings(spark, path, ["page", "linked_from", "url"])


@query("sink_csv_roundtrip", f"with {CLEAN_O} select title, url, error_class, message from rows_o where status = 'error'",
       ["wiki_pages"])
def q_sink_csv_roundtrip(spark, sf):
    from elcorpus.sinks import append_csv
    from elcorpus.sources import read_csv_strings
    path = _scratch(spark, "errors_csv")
    rows = C.cleaned_rows(_fx(spark, sf, "wiki_pages")).filter(F.col("status") == "error")
    rows = rows.select("title", "url", "error_class", "message")
    # two appends (e.g. two runs), each with its own header
    append_csv(rows.filter(F.col("title") < "Doc_5"), path)
    append_csv(rows.filter(F.col("title") >= "Doc_5"), path)
    return read_csv_strings(spark, path, ["title", "url", "error_class", "message"])


@query("scan_html_jsonl", "select input_seq, page, url, text from wiki_pages", ["wiki_pages"])
def q_scan_html_jsonl(spark, sf):
    from elcorpus.sources import read_html_pages
    path = _scratch(spark, "html_pages_jl")
    _fx(spark, sf, "wiki_pages").write.json(path)
    return read_html_pages(spark, path).select("input_seq", "page", "url", "text")


@query("sink_jsonl_roundtrip", ENTITIES_O, ["wiki_pages", "wikidata_dump"])
def q_sink_jsonl_roundtrip(spark, sf):
    from elcorpus.sinks import write_gzip_jsonl
    from pyspark.sql import types as Ty
    path = _scratch(spark, "entities_jl_gz")
    write_gzip_jsonl(entities_query(spark, sf), path)
    schema = Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in D.ENTITY_COLUMNS])
    return spark.read.schema(schema).json(path)


@query("scan_wikidata_dump", f"with {DUMP_O} select line from dl", ["wikidata_dump"])
def q_scan_wikidata_dump(spark, sf):
    from elcorpus.sources import read_wikidata_dump
    path = _scratch(spark, "dump_bz2")
    _fx(spark, sf, "wikidata_dump").write.option("compression", "bzip2").text(path)
    return E.dump_lines(read_wikidata_dump(spark, path))


@query("stream_incremental_clean", f"with {CLEAN_O} select title, url, qid, text from cleaned_o", ["wiki_pages"])
def q_stream_incremental_clean(spark, sf):
    """I1 end to end: the fixture pages arrive in two goes (first fetch, then
    re-fetches), each cleaned by a start of the stream; the output equals the
    batch J4."""
    from elcorpus.sources import read_cleaned_pages
    from elcorpus.streaming import start_incremental_clean
    base = _scratch(spark, "stream")
    wp = _fx(spark, sf, "wiki_pages")
    for k, own in (("1", F.col("input_seq") < 1000000000), ("2", F.col("input_seq") >= 1000000000)):
        wp.filter(own).write.json(f"{base}/in/{k}")
        _place_parts(spark, f"{base}/in/{k}", f"{base}/inbox", f"batch-{k}")
        start_incremental_clean(spark, f"{base}/inbox", f"{base}/out", f"{base}/err", checkpoint=f"{base}/ckpt").awaitTermination()
    return read_cleaned_pages(spark, f"{base}/out")


@query("stream_dedupe_titles", """
select concat('Doc_', cast(doc_id as varchar)) as title, 1 as fetch from documents
union all select distinct concat('Neu_', cast(doc_id as varchar)) as title, 3 as fetch from labels
union all select distinct concat('Neuer_', cast(doc_id as varchar)) as title, 4 as fetch from labels
union all select distinct concat('Doc_', cast(doc_id as varchar)) as title, 5 as fetch from labels where toxic = 1""")
def q_stream_dedupe_titles(spark, sf):
    """Five fetches arrive in turn.  The second repeats titles of the day
    before (they go); the third and fourth bring new titles a month later, so
    that the first ones are forgotten; the fifth brings some of those again
    (they are let through), each twice (once)."""
    from elcorpus.streaming import STATE_STORE, dedupe_titles
    base = _scratch(spark, "stream-titles")
    docs, labels = _tbl(spark, sf, "documents").select("doc_id"), _tbl(spark, sf, "labels").select("doc_id", "toxic")
    toxic = labels.filter("toxic = 1").select("doc_id")
    fetches = ((1, "2024-03-01", "Doc_", docs), (2, "2024-03-02", "Doc_", toxic), (3, "2024-04-01", "Neu_", labels),
               (4, "2024-04-02", "Neuer_", labels), (5, "2024-04-03", "Doc_", toxic.unionAll(toxic)))
    for k, day, prefix, rows in fetches:
        rows = rows.select(F.concat(F.lit(prefix), F.col("doc_id").cast("string")).alias("title"), F.lit(k).alias("fetch"), F.lit(day).alias("fetched"))
        rows.write.json(f"{base}/in/{k}")
        _place_parts(spark, f"{base}/in/{k}", f"{base}/inbox", f"fetch-{k}")
    old = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        for k in range(1, 6):  # one start for each fetch, as by a scheduler; the last batch of a start forgets
            stream = spark.readStream.schema("title string, fetch int, fetched timestamp").option("pathGlobFilter", "fetch-[1-%d]_*" % k).json(f"{base}/inbox")
            q = dedupe_titles(stream, "fetched", "2 days").writeStream.format("json").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
            q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STATE_STORE[0], old)
    return spark.read.schema("title string, fetch int").json(f"{base}/out")
