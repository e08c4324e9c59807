"""Toxicity, hard negatives and spelling variants against brute force, on
tables with nulls, ties, repeated rows and columns with clashing names."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from elcorpus.llm import hard_negatives, spelling, textops, toxicity
from tests.conftest import SF_SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


# -- spelling variants --------------------------------------------------------

def expected_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = sorted(w for w in n if len(w) >= 7 and n[w] >= 2)

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    form, count = {}, {}
    for w in words:
        found = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, ()) if near(w, v)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        count[w], form[w] = len(found), best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return out


def spelled():
    rng = np.random.default_rng(4)
    stems = ["accommodate", "mississippi", "aaaaaaa", "aaaaaaaa", "Ünïcôdé÷word", "ZEBRAFISHES", "abcdefg", "x" * 3000]
    texts = [None, "", "12 !?", "short one"]
    for k, stem in enumerate(stems):
        texts += [f"{stem} {stem}"] * (1, 12, 130)[k % 3]
        for _ in range(40):
            at, c = int(rng.integers(len(stem))), "abyéÿ"[rng.integers(5)]
            edit = (stem[:at] + stem[at + 1:], stem[:at] + c + stem[at:], stem[:at] + c + stem[at + 1:])[rng.integers(3)]
            texts.append(" ".join([edit] * int(rng.choice([1, 2, 2, 3, 25]))))
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(5, rows[5][1]), (5, rows[5][1]), (None, "accommodate accomodate accomodate")]


def test_spelling_variants(spark):
    rows = spelled()
    docs = spark.createDataFrame([(*r, "w", 1, "p", 2) for r in rows], "doc_id long, text string, word string, n int, id string, run int").repartition(5)
    got = [tuple(r) for r in spelling.variants(docs).collect()]
    want = expected_variants(rows)
    assert set(got) == want and len(got) == len(want)
    assert any(r[1] is not None and r[2] != r[1] for r in got)  # a chain of forms
    assert spelling.variants(docs.where("1 = 0")).collect() == []


def test_spelling_over_the_table(spark):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = [tuple(r) for r in spelling.variants(documents).collect()]
    want = expected_variants([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])
    assert set(got) == want and len(got) == len(want)


def test_trie_nodes_are_numbered_over_partitions(spark):
    words = ["a", "ab", "abc", "abd", "b", "ba", "bab", "cab", "dab", "dabble", "zz"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    rows, known = spelling.pairs(df)
    ids = {r["word"]: r["id"] for r in known.collect()}
    assert sorted(ids, key=ids.get) == sorted(words)  # numbers rise with the words
    prefixes, suffixes = {}, {}
    seen = Counter()
    for r in rows.collect():
        seen[r["id"]] += 1
        prefixes.setdefault(r["p"], set())
        suffixes.setdefault(r["s"], set())
    assert seen == {ids[w]: 2 * len(w) + 1 for w in words}
    assert len(prefixes) == len({w[:k] for w in words for k in range(len(w) + 1)})
    assert len(suffixes) == len({w[k:] for w in words for k in range(len(w) + 1)})


# -- hard negatives -----------------------------------------------------------

def vectors():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1300):
        label, vec = int(rng.integers(4)), rng.normal(0, 0.2, 8)
        vec[label] += 0.5
        rows.append((i, [float(x) for x in np.float32(vec)], label))
    same = rows[200][1]
    rows += [(2000 + i, same, i % 3) for i in range(300)]  # ties and a common vector
    rows += [(3000, [0.0] * 8, 1), (3100, None, 1), (3200, [1.0] * 8, None), (3201, [float("nan")] * 8, 1), (3202, [float("inf")] + [1.0] * 7, 1), (3203, [None] + [1.0] * 7, 2), (3300, [-1.0] * 8, 2)]
    return rows


def mined(rows, every=100, positives=5, negatives=10):
    kept = []
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        kept.append((i, [int(np.floor(256 * x)) for x in vec], (label + 1) % 10 if i % 7 == 0 else label))
    v = np.array([r[1] for r in kept], np.int64)
    out = []
    for a, (i, _, label) in enumerate(kept):
        if i % every:
            continue
        score = v @ v[a]
        order = sorted((b for b in range(len(kept)) if b != a), key=lambda b: (-score[b], kept[b][0]))
        for p in [b for b in order if kept[b][2] == label][:positives]:
            good = [b for b in order if kept[b][2] != label and 30 * score[p] <= 100 * score[b] <= 90 * score[p]]
            out += [(i, kept[p][0], k, kept[b][0], int(score[p]), int(score[b])) for k, b in enumerate(good[:negatives], 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block_anchors", [4096, 8])
def test_hard_negatives(spark, block_anchors):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", row long, score int").repartition(6)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df, block_anchors=block_anchors).collect())
    assert got == mined(rows)


def test_hard_negatives_sql(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF_SMALL}/embeddings.parquet'")
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == sorted(con.execute(hard_negatives.ORACLE).fetchall())


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.hard_negatives(none).collect() == []
    # a null id, a repeated anchor, and vectors of other lengths
    rows = [(100, [1.0, 1.0], 1), (100, [1.0, 1.0], 1), (1, [1.0], 1), (2, [0.5, 0.25, 9.0], 2), (None, [0.5, 0.25], 2)]
    got = Counter(tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    want = [(100, p, k, n, s, 49152) for p, s in ((100, 131072), (1, 65536)) for k, n in ((1, 2), (2, None))]
    assert got == Counter(want * 2)
    huge = spark.createDataFrame([(100, [1e16, 0.0], 1), (1, [1e16, 0.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="does not fit"):
        hard_negatives.hard_negatives(huge).collect()


def test_walk_ends_early_and_is_exact():
    rng = np.random.default_rng(8)
    centre = rng.normal(0, 1, (30, 16))
    vecs = np.floor(256 * (np.repeat(centre, 200, 0) + rng.normal(0, 0.1, (6000, 16)))).astype(np.int64)
    rows, labels = np.arange(6000), np.zeros(6000, np.int64)
    pick = np.arange(0, 400, 10)
    low, high = np.full((40, 1), -(1 << 62)), np.full((40, 1), 1 << 62)
    done = 0
    for cone in hard_negatives.cones(labels[pick], rows[pick], vecs[pick], low, high, 5, size=20):
        done += cone.walk(rows, rows, labels, vecs, hard_negatives.units(vecs), hard_negatives.lengths(vecs), True)
        for m in range(len(cone.rows)):
            score = vecs @ cone.vecs[m]
            want = sorted((-score[b], b) for b in range(6000) if b != cone.rows[m])[:5]
            assert [(s, i) for s, i in zip(*cone.best[2:4, cone.best[0] == m], strict=True)] == want
    assert done < 40 * 6000 / 4  # most of the list is never multiplied


# -- toxicity -----------------------------------------------------------------

def interactions(seed, n):
    """Toxic only by pairs: no sum of single weights tells them apart."""
    rng = np.random.default_rng(seed)
    kinds = {0: [], 1: ["aaa", "bbb"], 2: ["ccc", "ddd"], 3: ["aaa", "ddd"], 4: ["ccc", "bbb"]}
    docs, y = [], []
    for _ in range(n):
        words = [f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(5, 200)) % 3000]
        kind = int(rng.integers(5))
        at = int(rng.integers(len(words) + 1))
        words[at:at] = kinds[kind]
        docs.append(" ".join(words))
        y.append(int(kind in (1, 2)))
    return docs, np.array(y, float)


def places(docs):
    batch = pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], ["text"])
    out = []
    for _, _, words in textops.texts_of(batch, textops.ALNUM_WORDS):
        out += [toxicity.terms(words)[a:b] for a, b in zip(words.by_doc[:-1], words.by_doc[1:], strict=True)]
    return out


def judged(model, docs):
    own = places(docs)
    return model.scores(np.concatenate(own), np.cumsum([0, *map(len, own)]))


def test_factors_learn_what_single_weights_miss():
    docs, y = interactions(1, 1500)
    model = toxicity.fitted(places(docs), y)
    test, goal = interactions(2, 600)
    right = ((judged(model, test) >= 0.5) == goal).mean()
    model.v[:] = 0
    additive = ((judged(model, test) >= 0.5) == goal).mean()
    assert right > 0.95 and additive < 0.85


def test_windows_of_a_document():
    model = toxicity.FactorizationMachine(np.unique(np.concatenate(places(["x y z"]))), factors=2)
    rng = np.random.default_rng(3)
    model.w, model.v, model.bias = rng.normal(0, 1, 3), rng.normal(0, 1, (3, 2)), -0.7
    by_place = dict(zip(model.places.tolist(), range(3), strict=True))
    texts = ["", "x", "x y", "q " * 30 + "x " + "q " * 30 + "y z", ("x " * 20 + "q " * 9 + "z ") * 9, "x y z " * 100]
    for text, score in zip(texts, judged(model, texts), strict=True):
        own = places([text])[0].tolist() if text else []
        blocks = [own[i:i + toxicity.BLOCK_WORDS] for i in range(0, len(own), toxicity.BLOCK_WORDS)]
        best = -np.inf
        for k in range(max(1, len(blocks) - 1)):
            t = sorted({by_place[p] for p in sum(blocks[k:k + 2], []) if p in by_place})
            z = model.bias + sum(model.w[i] for i in t) + sum(model.v[i] @ model.v[j] for a, i in enumerate(t) for j in t[a + 1:])
            best = max(best, z)
        assert score == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-9)


def test_toxicity_of_tables(spark):
    docs, y = interactions(5, 700)
    docs = [d.replace("aaa", "Vile").replace("bbb", "folk") for d in docs]
    rows = [(i, t, 0.1, "k") for i, t in enumerate(docs)] + [(900, None, None, None), (901, "", None, None), (0, docs[0], None, None), (902, "word " * 60000 + docs[[int(v) for v in y].index(1)], 1.0, "k")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, int(v), "c") for i, v in enumerate(y)] + [(900, None, "c"), (901, 0, "c"), (901, 1, "c")], "doc_id long, toxic int, text string")
    got = toxicity.toxicity(documents, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    held = [(r["predicted"], int(y[r["doc_id"]])) for r in got if r["held_out"] and r["doc_id"] < 700]
    assert len(held) > 80 and sum(a == b for a, b in held) > 0.9 * len(held)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[902]["predicted"] == 1  # found at the end of a long text
    assert by_id[900]["score"] == by_id[901]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert toxicity.toxicity(documents.where("1 = 0"), labels).collect() == []
    assert {r["score"] for r in toxicity.toxicity(documents, labels.where("toxic = 1")).collect()} == {1.0}
    assert {r["score"] for r in toxicity.toxicity(documents, labels.where("1 = 0")).collect()} == {0.0}


def test_toxicity_held_out(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = got.where("held_out").join(labels, "doc_id").where("toxic is not null").select("predicted", "toxic").collect()
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    wrong = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(caught) > 0.7 * len(caught) and sum(wrong) < 0.01 * len(wrong)
