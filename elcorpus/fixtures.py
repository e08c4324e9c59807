"""Stage inputs derived, in portable SQL, from the driver tables.

The pipeline's natural inputs (MediaWiki page HTML, a knowledge-base dump,
category listings) are not among the driver tables, so each is built by SQL
from ``documents`` (whole table, whole texts) and ``labels``.  The same text
runs unchanged in Spark SQL and DuckDB, so a query's Spark plan and its
DuckDB oracle read identical inputs, and the work grows with the tables.

Fixture rules (all rows of ``documents`` take part):
* ``wiki_pages``: one page per document; the document text becomes one
  ``<p>`` per line.  ``doc_id`` picks the variant: missing page, page
  without container, banner, infobox, edit links, boilerplate section,
  footnote, math (alt / displaystyle / neither / img without alt), internal,
  namespace, percent-encoded, fragment, red and colon-less links, absent
  qid.  Documents flagged ``toxic`` in ``labels`` are fetched a second time
  (later ``input_seq``, other URL), which gives duplicate titles.
* ``wikidata_dump``: one dump line per document (trailing comma), a
  property line instead of an item for some ids, the ``[``/``]`` rows, and a
  second line (same id, other content) for every document with
  ``quality = 0``.
* ``category_lines``: one listing line per document: bullets with one or
  two labels, bullets without a label, non-bullet lines.
"""

from __future__ import annotations

WIKI_PAGES_SQL = r"""
with base as (
select doc_id as input_seq, concat('Doc_', cast(doc_id as varchar(20))) as page,
 concat('https://fr.wikipedia.org/wiki/Doc_', cast(doc_id as varchar(20))) as url,
 case when doc_id % 17 = 3 then '<html><body><div class="noarticletext">vide</div></body></html>'
      when doc_id % 23 = 5 then '<html><body><p>no container</p></body></html>'
      when doc_id % 31 = 7 then '<html><body><div id="mw-content-text"><p>no parser output</p></div></body></html>'
 else concat('<!DOCTYPE html><html><head><title>Doc</title></head><body><div id="mw-content-text"><div class="mw-parser-output">',
  case when doc_id % 5 = 0 then '<div class="bandeau-container homonymie"><p>bandeau <a href="/wiki/Doc_3" title="Doc 3">b</a></p></div>' else '' end,
  case when doc_id % 4 = 0 then '<table class="infobox_v3"><tr><td><p><a href="/wiki/Doc_1" title="Doc 1">x</a></p></td></tr></table>' else '' end,
  '<p><b>Doc ', cast(doc_id as varchar(20)), '</b> ',
  '<a href="/wiki/Doc_', cast((doc_id * 7 + 1) % 200 as varchar(20)), '" title="Doc ', cast((doc_id * 7 + 1) % 200 as varchar(20)), '">lien <i>a</i></a> ',
  '<a href="/wiki/Projet:Doc" title="Projet:Doc">ns</a> <a href="/w/index.php?title=R&amp;redlink=1" title="R">red</a>',
  '<sup><a href="/wiki/Doc_2" title="Doc 2">[1]</a></sup>', chr(10), '</p>',
  '<p>', replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10), concat(chr(10), '</p><p>')), chr(10), '</p>',
  '<p>Formule',
  case doc_id % 8 when 2 then concat(' <span class="mwe-math-element"><img alt="{', chr(92), 'displaystyle x}"></span>')
                  when 6 then concat(' <span class="mwe-math-element">y', chr(10), '2{', chr(92), 'displaystyle y}</span>')
                  when 7 then ' <span class="mwe-math-element">abc</span>'
                  when 3 then case when doc_id % 29 = 11 then ' <span class="mwe-math-element"><img src="m"></span>' else '' end else '' end,
  ' <a href="/wiki/Mod%C3%A8le:X" title="X">tpl</a> <a href="/wiki/Doc_9#Vie" title="Doc 9">frag</a> <a href="/wiki/Aide_sociale" title="Aide sociale">aide</a>',
  ' <a href="/wiki/Doc_', cast((doc_id * 13 + 5) % 250 as varchar(20)), '" title="Doc ', cast((doc_id * 13 + 5) % 250 as varchar(20)), '">lien &amp; b</a>', chr(10), '</p>',
  '<h2>Histoire<span class="mw-editsection">[modifier]</span></h2><ul><li>liste</li></ul>',
  case when doc_id % 2 = 0 then '<h2>Notes et références<span class="mw-editsection">[modifier]</span></h2>' else '' end,
  '<p>fin', chr(10), '</p></div></div>',
  case when doc_id % 6 = 1 then '' else concat('<a href="https://www.wikidata.org/wiki/Special:EntityPage/Q', cast(doc_id as varchar(20)), '">wd</a>') end,
  '</body></html>') end as text
from documents
)
select input_seq, page, url, text from base
union all
select b.input_seq + 1000000000 as input_seq, b.page, concat(b.url, '?dup=1') as url,
 case when b.text like '%no container%'
      then '<html><body><div id="mw-content-text"><div class="mw-parser-output"><p>repris</p></div></div></body></html>'
      else replace(b.text, '<p>fin', '<p>fin bis') end as text
from base b join labels l on l.doc_id = b.input_seq
where l.toxic = 1
"""

WIKIDATA_DUMP_SQL = r"""
with items as (
select doc_id, concat('{"type":"', case when doc_id % 10 = 9 then 'property","id":"P' else 'item","id":"Q' end,
 cast(doc_id as varchar(20)), '","labels":{',
 case when doc_id % 3 = 0 then '"en":{"language":"en","value":"x"}' else concat('"fr":{"language":"fr","value":"Label ', cast(doc_id as varchar(20)), '"}') end,
 '},"descriptions":{', case when doc_id % 4 = 0 then '' else concat('"fr":{"language":"fr","value":"desc ', cast(doc_id as varchar(20)), '"}') end,
 '},"aliases":{', case when doc_id % 5 = 0 then '"fr":[{"language":"fr","value":"a1"},{"language":"fr","value":"a2"}]' else '' end,
 '},"claims":{"P31":[', case when doc_id % 7 = 0 then '{"mainsnak":{"snaktype":"somevalue"}},' else '' end,
 '{"mainsnak":{"datavalue":{"value":{"id":"', case doc_id % 6 when 0 then 'Q577' when 1 then 'Q5' when 2 then 'Q6465' when 3 then 'Q43229' else 'Q1' end, '"}}}}]',
 case when doc_id % 11 = 0 then ',"P569":[]' else '' end, case when doc_id % 13 = 0 then ',"P625":[]' else '' end, '}},') as value
from documents
)
select value from items
union all
select concat('{"type":"', case when i.doc_id % 10 = 9 then 'property","id":"P' else 'item","id":"Q' end,
 cast(i.doc_id as varchar(20)), '","labels":{"fr":{"language":"fr","value":"Autre ',
 cast(i.doc_id as varchar(20)), '"}},"descriptions":{},"aliases":{},"claims":{}},') as value
from items i join labels l on l.doc_id = i.doc_id
where l.quality = 0
union all select '[' as value
union all select ']' as value
"""

CATEGORY_LINES_SQL = r"""
select concat(case doc_id % 3 when 0 then '*' when 1 then '* ' else 'Liste : ' end,
 cast(doc_id % 28 + 1 as varchar(20)), ' mars {{a-label|Doc ', cast(doc_id as varchar(20)), '}}',
 case when doc_id % 6 = 0 then ' {{a-label|Ignored}}' else '' end) as value
from documents
union all select 'pas une puce {{a-label|X}}' as value
union all select '*{{a-label|Y}}' as value
union all select '* sans modele' as value
"""

# Titles and URLs for the scalar predicates: the hand samples, and from every
# document's first line a title (with namespace, fragment, quote, script and
# accent variants) and a second one that differs from it in its quotes alone.
_FIRST_LINE = "split_part(coalesce(text, ''), chr(10), 1)"

TITLE_INPUTS_SQL = f"""
select id, title from (values (1, 'Paris'), (2, '  Tour Eiffel '), (3, 'Projet Manhattan'), (4, 'Projet:Math'), (5, 'Paris#Histoire'),
 (6, 'Discussion utilisateur:A'), (7, 'MODULE lunaire'), (8, 'A/B & C+D~*'), (9, 'L''Assommoir (roman)'), (10, 'Cours'),
 (11, 'TourEiffel'), (12, 'L’Assommoir (roman)'), (13, 'Éléphant'), (14, 'Elephant')) as t(id, title)
union all
select 2 * doc_id + 1000 as id, concat(case doc_id % 6 when 0 then 'Projet:' when 1 then 'Aide ' when 2 then '  ' when 3 then 'L''' when 4 then 'Discussion utilisateur:' else '' end,
 {_FIRST_LINE}, case doc_id % 11 when 0 then '#Vie' when 1 then ' (été)' when 2 then ' / « B »' when 3 then ' ' when 4 then ' Iași Việt Łódź Þór straße'
 when 5 then ' Ελλάδα Ψυχή Χάος' when 6 then ' Владимир Щукин Хрущёв объезд Київ' when 7 then ' 서울 한국어' when 8 then ' さくら カタカナ' when 9 then ' Ⅷ ½ ﬁn Ａｂ' else ' 東京' end) as title
from documents
union all
select 2 * doc_id + 1001 as id, concat('L’', {_FIRST_LINE}) as title from documents
union all
select -1 - doc_id as id, concat('L''', {_FIRST_LINE}) as title from documents
"""

URL_INPUTS_SQL = f"""
select id, url from (values (1, '/wiki/Paris'), (2, '/wiki/Mod%C3%A8le:X'), (3, '/wiki/'), (4, '/w/index.php?title=X'), (5, '/wiki/Paris#H'),
 (6, 'https://fr.wikipedia.org/wiki/Fichier:A.jpg'), (7, '/WIKI/Lyon'), (8, '/wiki/D%C3%A9finition_de_gadget:Z')) as t(id, url)
union all
select doc_id + 1000 as id, concat(case doc_id % 4 when 0 then '/wiki/' when 1 then 'https://fr.wikipedia.org/wiki/' when 2 then '/w/index.php?title=' else '/WIKI/' end,
 case doc_id % 5 when 0 then 'Projet:' when 1 then 'Mod%C3%A8le:' when 2 then 'Aide_' else '' end, replace({_FIRST_LINE}, ' ', '_'),
 case when doc_id % 9 = 0 then '#H' else '' end) as url
from documents
"""

FIXTURES = {
    "wiki_pages": WIKI_PAGES_SQL,
    "wikidata_dump": WIKIDATA_DUMP_SQL,
    "category_lines": CATEGORY_LINES_SQL,
    "title_inputs": TITLE_INPUTS_SQL,
    "url_inputs": URL_INPUTS_SQL,
}

DRIVER_TABLES = ("documents", "labels", "pages")


def with_fixtures(sql: str, names) -> str:
    """Prefix ``sql`` with the fixture CTEs it needs (for DuckDB oracles)."""
    ctes = ",\n".join(f"{n} as ({FIXTURES[n]})" for n in names)
    return f"with {ctes}\n{sql}"


def register(spark, sf_dir: str, names=None):
    """Register driver tables and fixture views in a Spark session."""
    for t in DRIVER_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for n in names or FIXTURES:
        spark.sql(FIXTURES[n]).createOrReplaceTempView(n)


def fixture(spark, sf_dir: str, name: str):
    """One fixture as a DataFrame (driver tables registered on the way)."""
    register(spark, sf_dir, [name])
    return spark.table(name)
