"""Plan shape and the shuffle (non-broadcast) join paths."""

import re
import tempfile

from pyspark.sql import functions as F

from elcorpus import registry as R
from elcorpus.operators import html as H
from elcorpus.plans import dataset as D
from elcorpus.plans import entities as E
from elcorpus.profile import MEDIAWIKI_FR
from tests.conftest import SF_SMALL


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_html_chain_has_one_exchange(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(F.col("page_id").alias("pk"), "html")
    plan = _physical(H.page_results(H.annotate(H.tokenize(pages), MEDIAWIKI_FR), MEDIAWIKI_FR))
    exchanges = re.findall(r"Exchange (\w+)", plan)
    assert exchanges == ["hashpartitioning"], exchanges
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    df = R.QUERIES["html_tokens"](spark, SF_SMALL)
    plan = _physical(df)
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans and all("embedding" not in s for s in scans)
    assert all("ReadSchema: struct<page_id:bigint,html:string>" in s for s in scans)


def test_shuffle_paths_equal_broadcast_paths(spark):
    """The paths a cluster takes when the small sides are not small:
    Spark's broadcast thresholds off."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        _compare_paths(spark, keys)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _compare_paths(spark, keys):
    cleaned = R._cleaned(spark, SF_SMALL)
    dump = R._fx(spark, SF_SMALL, "wikidata_dump")
    wd_b = E.entity_features(dump, cleaned)
    ent_b = D.entities(cleaned, wd_b)
    rows_b = sorted(map(tuple, wd_b.collect()))
    key = lambda r: tuple("" if v is None else v for v in r)
    ents_b = sorted(map(key, ent_b.collect()))
    for k in keys:
        spark.conf.set(k, "-1")
    wd_s = E.entity_features(dump, cleaned)
    assert rows_b == sorted(map(tuple, wd_s.collect()))
    # the bounded bit filter is the only side that is broadcast
    ent_s = D.entities(cleaned, wd_s)
    for df in (wd_s, ent_s):
        joins = [line for line in _physical(df).split("\n") if "BroadcastHashJoin" in line]
        assert joins and all("_ask" in line for line in joins)
    assert ents_b == sorted(map(key, ent_s.collect()))


def test_page_partitions_follow_the_session(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").withColumnRenamed("page_id", "pk")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert H.partition_pages(pages).rdd.getNumPartitions() == n
    assert H.partition_pages(pages, num_partitions=3).rdd.getNumPartitions() == 3


def test_page_partitions_grow_with_the_html(spark, monkeypatch):
    from elcorpus.plans import link_graph as L
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = [f"<div id='mw-content-text'><div class='mw-parser-output'><p>{'x' * 1000}<a href='/wiki/B' title='B'>b</a></p></div></div>"] * (4 * n)
    rows = [(i, f"T{i}", "u", t) for i, t in enumerate(texts)] + [(len(texts), "Null", "u", None)]
    pages = spark.createDataFrame(rows, "input_seq long, page string, url string, text string")
    monkeypatch.setattr(H, "PARTITION_BYTES", 1024)
    want = -(-sum(map(len, texts)) // 1024)
    assert H.partition_pages(pages, "input_seq", html="text").rdd.getNumPartitions() == want > n
    assert H.page_partitions(pages.limit(0), "text") == n
    # the link graph's pages are partitioned by that number, too, and not by a join's shuffle
    for limit in (1024, 1 << 30):
        monkeypatch.setattr(H, "PARTITION_BYTES", limit)
        links = L.link_graph(pages.select(F.col("page").alias("title")), pages)
        assert links.count() == 2 * len(texts) + 1
        assert "REPARTITION_BY_NUM" in _physical(links)


def test_frontier_is_keyed_by_title(spark):
    from elcorpus.plans import link_graph as L
    links = spark.createDataFrame([("Cote", "", "u1"), ("Côté", "", "u2"), ("Côte", "", "u3")], "page string, linked_from string, url string")
    cached = spark.createDataFrame([("Côte",)], "page string")
    assert sorted(r["page"] for r in L.fetch_frontier(links, cached).collect()) == ["Cote", "Côté"]


def test_long_character_references(spark):
    from elcorpus.functions.strings import decode_entities
    from pyspark.sql import functions as F
    x = spark.createDataFrame([("&#00000233;&#x0000000e9;&#99999999999;&#233;",)], "t string")
    assert x.select(decode_entities(F.col("t")).alias("t")).first()["t"] == "éé&#99999999999;é"


def test_cleaning_reads_once_shuffles_once_and_sorts_four_times(spark):
    from elcorpus.plans import clean as C
    base = tempfile.mkdtemp(prefix="elcorpus-plan-")
    R._fx(spark, SF_SMALL, "wiki_pages").write.parquet(f"{base}/pages")
    plan = _physical(C.cleaned_rows(spark.read.parquet(f"{base}/pages")))
    plan = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bSort \[", plan)) <= 4
    assert re.findall(r"Exchange (\w+)", plan) == ["hashpartitioning"]
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "Join" not in plan


def test_results_of_cleaning_read_written_rows(spark):
    from elcorpus.plans import clean as C
    for df in C.clean_pages(R._fx(spark, SF_SMALL, "wiki_pages")):
        plan = _physical(df)
        assert "Window" not in plan and "Generate" not in plan  # nothing is cleaned again


def test_dump_lines_are_filtered_before_they_are_shuffled(spark):
    from elcorpus.operators.bit_filter import bit_words, maybe_among
    base = tempfile.mkdtemp(prefix="elcorpus-plan-")
    spark.range(20000).selectExpr("concat('{\"type\":\"item\",\"id\":\"Q', id, '\",\"x\":1},') as value").write.text(f"{base}/dump")
    spark.range(0, 20000, 40).selectExpr("concat('Q', id) as qid").write.parquet(f"{base}/qids")
    qids = spark.read.parquet(f"{base}/qids")
    items = E.dump_items(E.dump_lines(spark.read.text(f"{base}/dump")))
    passed = maybe_among(items, qids, "qid")
    got = {r["qid"] for r in passed.select("qid").collect()}
    wanted = {f"Q{i}" for i in range(0, 20000, 40)}
    assert wanted <= got and len(got - wanted) < 0.02 * 20000
    full = maybe_among(items, qids, "qid", word_bits=2)  # a filter far too small still drops nothing wanted
    assert wanted <= {r["qid"] for r in full.select("qid").collect()}
    assert bit_words(items, "qid", word_bits=5).count() <= 32
    # what reaches the exchange of the lines has passed the filter
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.wanted_items(items, qids)._jdf.queryExecution().sparkPlan().toString()
        joins = [line for line in plan.split("\n") if "LeftSemi" in line]
        assert len(joins) == 2 and "qid" in joins[0] and "_ask" in joins[1]  # the filter is below
        assert {r["qid"] for r in E.wanted_items(items, qids).collect()} == wanted
        line = passed._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(qid", line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_read_in_order(spark):
    from elcorpus.sinks import write_sorted_titles
    from elcorpus.sources import read_lines_in_order
    base = tempfile.mkdtemp(prefix="elcorpus-order-")
    titles = spark.range(5000).selectExpr("concat('t', hash(id), repeat('é', id % 7)) as title")
    write_sorted_titles(titles, f"{base}/titles")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks a file
    try:
        rows = read_lines_in_order(spark, f"{base}/titles").orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted({r["title"] for r in titles.collect()}, key=lambda t: t.encode())
    assert [r["value"] for r in rows] == want and [r["place"] for r in rows] == list(range(1, len(want) + 1))
