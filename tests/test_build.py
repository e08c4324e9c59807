"""End-to-end build from files, compared with the registered query plans,
plus the properties of SURVEY section 5."""

import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F

from elcorpus import fixtures as fx
from elcorpus import registry as R
from elcorpus.plans.build import run
from tests.conftest import SF_SMALL


def _write_inputs(spark, base):
    fx.register(spark, SF_SMALL)
    cat = f"{base}/categories"
    os.makedirs(cat)
    lines = [r.value for r in spark.table("category_lines").collect()]
    with open(f"{cat}/Wikipédia_Bons_articles_Justification_de_leur_promotion_2021.txt", "w") as f:
        f.write("\n".join(lines[: len(lines) // 2]) + "\n")
    with open(f"{cat}/Wikipédia_Articles_de_qualité_Justification_de_leur_promotion_2022.txt", "w") as f:
        f.write("\n".join(lines[len(lines) // 2:]) + "\n")
    with open(f"{cat}/Autre_page.txt", "w") as f:
        f.write("* x {{a-label|Decoy}}\n")
    spark.table("wiki_pages").write.json(f"{base}/html-pages.jl")
    spark.table("wikidata_dump").write.option("compression", "bzip2").text(f"{base}/dump.json.bz2")


def _read_gz_jsonl(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.endswith(".gz"):
            with gzip.open(os.path.join(path, name), "rt", encoding="utf-8") as f:
                out.extend(json.loads(line) for line in f)
    return out


def test_build_matches_query_plans(spark):
    base = tempfile.mkdtemp(prefix="elcorpus-build-")
    _write_inputs(spark, base)
    paths = run(spark, f"{base}/categories", f"{base}/html-pages.jl", f"{base}/dump.json.bz2", f"{base}/out")
    ents = _read_gz_jsonl(paths["entities"])
    want = {tuple(r) for r in R.entities_query(spark, SF_SMALL).select(*sorted(ents[0])).collect()}
    got = {tuple(e[k] for k in sorted(e)) for e in ents}
    assert got == want
    assert all(len(e) == 8 for e in ents)          # every key present, nulls kept
    corpus = _read_gz_jsonl(paths["corpus"])
    assert {c["title"] for c in corpus} == {r.title for r in R.QUERIES["corpus"](spark, SF_SMALL).collect()}
    # resume: a second run cleans nothing new
    before = spark.read.json(paths["cleaned"]).count()
    run(spark, f"{base}/categories", f"{base}/html-pages.jl", f"{base}/dump.json.bz2", f"{base}/out")
    assert spark.read.json(paths["cleaned"]).count() == before


class Ended(Exception):
    pass


def test_a_build_ended_after_any_stage_goes_on(spark, monkeypatch):
    """Ended before and after the mark of each stage in turn, the build goes
    on; its outputs are those of a build in one go."""
    from elcorpus.plans import build
    base = tempfile.mkdtemp(prefix="elcorpus-restart-")
    _write_inputs(spark, base)
    args = (spark, f"{base}/categories", f"{base}/html-pages.jl", f"{base}/dump.json.bz2")
    whole = run(*args, f"{base}/whole")
    plain, seen = build.Run.stage, {}

    def stage(self, name, work):
        if self.is_done(name):
            return
        seen[name] = seen.get(name, 0) + 1
        if seen[name] == 1:  # done, but ended before its mark
            work()
            raise Ended(name)
        plain(self, name, work)
        if name == "cleaned":
            raise Ended(name)

    monkeypatch.setattr(build.Run, "stage", stage)
    for _ in range(40):
        try:
            paths = run(*args, f"{base}/out")
            break
        except Ended:
            pass
    assert set(seen.values()) == {2}
    monkeypatch.undo()
    rows = lambda p, kind: sorted(map(tuple, getattr(spark.read.option("header", True), kind)(p).collect()), key=str)
    for key in whole:
        kind = "json" if "json" in whole[key] or whole[key].endswith(".jl") else "csv" if whole[key].endswith(".csv") else "text"
        assert rows(paths[key], kind) == rows(whole[key], kind), key
    titles = [r[0] for r in spark.read.json(paths["cleaned"]).select("title").collect()]
    assert len(titles) == len(set(titles))


def test_marks_equal_edges_and_no_tags(spark):
    rows = R.QUERIES["clean_text"](spark, SF_SMALL).filter("status = 'ok'")
    marks = rows.select(F.size(F.split("text", r"\[E=")).alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    ok_ids = rows.select("input_seq")
    n_annot = (R.QUERIES["annotate_links"](spark, SF_SMALL).join(ok_ids, "input_seq", "left_semi")
               .agg(F.sum("n_marks")).first()[0])
    assert marks == n_annot
    assert rows.filter(F.col("text").rlike("<[a-zA-Z/]")).count() == 0


def test_stream_equals_batch(spark):
    s = {tuple(r) for r in R.QUERIES["stream_incremental_clean"](spark, SF_SMALL).select("title", "url", "qid", "text").collect()}
    b = {tuple(r) for r in R.QUERIES["clean_pages"](spark, SF_SMALL).select("title", "url", "qid", "text").collect()}
    assert s == b
