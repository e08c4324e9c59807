"""Benchmark decontamination: a broadcast hash set of benchmark n-grams,
training windows scanned against it, hits verified word by word.

The benchmark's windows are broadcast in blocks of at most
``block_windows`` windows, so a task never holds more than one block of a
benchmark of any size; the usual benchmark is a single block.

Defined results: null or wordless texts have no words and no hits; a null
item text gives no window; a null item id is listed as an empty id; repeated
items with one id count once; repeated documents are judged one by one;
empty tables give empty results.  Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import keyed, ship, written

WINDOW = 10
#: Windows in one broadcast block (about 100 bytes each).
BLOCK_WINDOWS = 200_000


def _normal(data: np.ndarray, words: T.Words, a: int, b: int) -> bytes:
    return b" ".join(T.ALNUM_WORDS[data[words.start[w]:words.end[w]]].tobytes() for w in range(a, b))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, length, words): each window of each item; a shorter item is
    one window of its own length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            data, offs = T.utf8(batch.column("text"))
            rows: list[tuple[str, int, bytes]] = []
            w = T.Words(data, offs, T.ALNUM_WORDS)
            for k, item in enumerate(ids):
                a, b = int(w.by_doc[k]), int(w.by_doc[k + 1])
                size = min(window, b - a)
                if size:
                    rows += [(item, size, _normal(data, w, s, s + size)) for s in range(a, b - size + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["item", "length", "words"])

    ship(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return items.mapInArrow(run, "item string, length int, words binary").distinct()


class NgramSet:
    """One broadcast block: window hashes by length, and what they stand for."""

    def __init__(self, rows):
        self.by_length: dict[int, np.ndarray] = {}
        self.meaning: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        found: dict[int, list[int]] = {}
        for item, length, words in rows:
            data = np.frombuffer(bytes(words), np.uint8)
            h = int(T.runs_of(T.Words(data, np.array([0, len(data)]), T.ALNUM_WORDS).hash, length)[0])
            found.setdefault(length, []).append(h)
            self.meaning.setdefault((length, h), {}).setdefault(bytes(words), []).append(item)
        for length, hashes in found.items():
            self.by_length[length] = np.unique(np.array(hashes, np.uint64))
        self.filters = {n: np.bincount((h >> np.uint64(44)).astype(np.int64), minlength=1 << 20).astype(bool) for n, h in self.by_length.items()}

    def hits(self, data: np.ndarray, words: T.Words) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """(first word, end word, items) of each verified window occurrence
        in a run of documents; windows never cross documents."""
        first, last, items = [], [], []
        for length, known in self.by_length.items():
            h = T.runs_of(words.hash, length)
            maybe = np.flatnonzero(self.filters[length][(h >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(known, h[maybe])
            at[at == len(known)] = 0
            maybe = maybe[known[at] == h[maybe]]
            doc = np.searchsorted(words.by_doc, maybe, "right")
            for s in maybe[words.by_doc[doc] >= maybe + length].tolist():
                own = self.meaning[(length, int(h[s]))].get(_normal(data, words, s, s + length))
                if own:
                    first.append(s)
                    last.append(s + length)
                    items.append(own)
        order = np.argsort(np.array(first, np.int64), kind="stable")
        return np.array(first, np.int64)[order], np.array(last, np.int64)[order], [items[k] for k in order.tolist()]


def blocks(benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, **cols) -> list[DataFrame]:
    """The benchmark's windows in blocks of a bounded size."""
    every = benchmark_windows(benchmark, window, **cols)
    n = max(1, -(-every.count() // max(1, block_windows // 2)))
    if n == 1:
        return [every]
    return [every.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k) for k in range(n)]


def _merged(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Maximal covered word runs of intervals sorted by their start."""
    if len(first) == 0:
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(last)
    begins = np.r_[True, first[1:] > reach[:-1]]
    return np.stack([first[begins], reach[np.r_[begins[1:], True]]], 1)


def scan(docs: DataFrame, block: DataFrame) -> DataFrame:
    """(row_key, doc_id, n_words, spans, items) of one block: hit word runs
    as little-endian int64 pairs."""
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in block.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = NgramSet(shared.value)
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            spans, items = [b""] * batch.num_rows, [[]] * batch.num_rows
            data, offs = T.utf8(batch.column("text"))
            for i, j in T.slices(offs):
                own = data[offs[i]:offs[j]]
                w = T.Words(own, offs[i:j + 1] - offs[i], T.ALNUM_WORDS)
                n_words[i:j] = np.diff(w.by_doc)
                first, last, found = known.hits(own, w)
                cut = np.searchsorted(first, w.by_doc)
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    a, b = int(cut[k]), int(cut[k + 1])
                    spans[i + k] = (_merged(first[a:b], last[a:b]) - w.by_doc[k]).astype("<i8").tobytes()
                    items[i + k] = sorted({x for f in found[a:b] for x in f})
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(n_words), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))], ["row_key", "doc_id", "n_words", "spans", "items"])

    return docs.mapInArrow(run, f"row_key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, spans binary, items array<string>")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, hit words, items with occurring windows."""
    docs = keyed(documents, id_col, text_col)
    parts = [scan(docs, b) for b in blocks(benchmark, window, block_windows)]
    found = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            found = found.unionByName(p)
        found = found.groupBy("row_key").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("spans").alias("many"), F.flatten(F.collect_list("items")).alias("items"))
    else:
        found = found.select("doc_id", "n_words", F.array("spans").alias("many"), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, sha = [], [], []
            for many, items in zip(batch.column("many").to_pylist(), batch.column("items").to_pylist(), strict=True):
                runs = np.frombuffer(b"".join(many), "<i8").reshape(-1, 2)
                runs = runs[np.argsort(runs[:, 0], kind="stable")]
                n_hit.append(int(np.diff(_merged(runs[:, 0], runs[:, 1]), axis=1).sum()))
                own = sorted(set(items))
                n_items.append(len(own))
                sha.append(hashlib.sha256(",".join(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.select("doc_id", "n_words", "many", "items").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, text_col: str = "text") -> DataFrame:
    """``documents`` without the hit spans (from the first hit word's start to
    the last one's end, until no window of any block is left); a document of
    which nothing but white space remains goes.  Clean texts stay as they are."""
    parts = blocks(benchmark, window, block_windows)
    if len(parts) > 1:
        return _by_rounds(documents, parts, text_col)
    shared = documents.sparkSession.sparkContext.broadcast([tuple(r) for r in parts[0].collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = NgramSet(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts: dict[int, str] = {}  # the cut ones alone; the others stay in the batch
            data, offs = T.utf8(batch.column(at))
            for i, j in T.slices(offs):
                own = data[offs[i]:offs[j]]
                w = T.Words(own, offs[i:j + 1] - offs[i], T.ALNUM_WORDS)
                first, _, _ = known.hits(own, w)
                for k in np.unique(np.searchsorted(w.by_doc, first, "right") - 1).tolist():
                    texts[i + k] = _cleaned(known, batch.column(at)[i + k].as_py())
            if texts:
                cut = np.zeros(batch.num_rows, bool)
                cut[sorted(texts)] = True
                kind = batch.schema.field(at).type
                some = pa.array([texts[k] for k in sorted(texts)], kind)
                batch = batch.set_column(at, batch.schema.field(at), pc.replace_with_mask(batch.column(at), pa.array(cut), some))
                keep = np.ones(batch.num_rows, bool)
                keep[[k for k, x in texts.items() if not x.strip()]] = False
                batch = batch.filter(pa.array(keep))
            yield batch

    return documents.mapInArrow(run, documents.schema)


def _by_rounds(documents: DataFrame, parts: list[DataFrame], text_col: str) -> DataFrame:
    """The same with many blocks: a round finds the spans of all blocks in the
    uncut texts and cuts them at once; the next reads the cut texts alone."""
    key, names = "row_key", documents.columns
    while {key, key + "_text"} & {n.lower() for n in names}:
        key += "_"
    docs = written(documents.withColumn(key, F.monotonically_increasing_id()), "decontaminate-rows")
    now = docs.select(F.col(key).alias("row_key"), F.lit(None).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    changed = None
    while True:
        found = None
        for block in parts:
            own = scan(now, block).where(F.length("spans") > 0).select("row_key", "spans")
            found = own if found is None else found.unionByName(own)
        hits = written(found.groupBy("row_key").agg(F.collect_list("spans").alias("many")), "decontaminate-hits")
        if hits.isEmpty():
            break
        cut = now.join(hits, "row_key").select("row_key", "text", "many").mapInArrow(_cut_batches, "row_key long, text string")
        now = written(cut.select("row_key", F.lit(None).cast("string").alias("doc_id"), "text"), "decontaminate-cut")
        latest = now.select("row_key", F.col("text").alias("cut_text"))
        # a text cut again replaces what the rounds before made of it
        changed = latest if changed is None else written(changed.join(latest, "row_key", "left_anti").unionByName(latest), "decontaminate-changed")
    if changed is None:
        return docs.select(*names)
    text = F.col(key + "_text")
    out = docs.join(changed.toDF(key, key + "_text"), key, "left").where(text.isNull() | (text != ""))
    return out.select(*[F.coalesce(text, F.col(n)).alias(n) if n == text_col else F.col(n) for n in names])


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, text) without the spans of all blocks; white space alone
    becomes the empty text."""
    for batch in batches:
        texts = []
        for text, many in zip(batch.column("text").to_pylist(), batch.column("many").to_pylist(), strict=True):
            runs = np.frombuffer(b"".join(many), "<i8").reshape(-1, 2)
            runs = runs[np.argsort(runs[:, 0], kind="stable")]
            data = np.frombuffer(text.encode(), np.uint8)
            text = _cut(data, T.Words(data, np.array([0, len(data)]), T.ALNUM_WORDS), runs[:, 0], runs[:, 1])
            texts.append(text if text.strip() else "")
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(texts, pa.string())], ["row_key", "text"])


def _cut(data: np.ndarray, w: T.Words, first: np.ndarray, last: np.ndarray) -> str:
    kept, at = [], 0
    for a, b in _merged(first, last).tolist():
        kept.append(data[at:w.start[a]].tobytes())
        at = int(w.end[b - 1])
    return b"".join([*kept, data[at:].tobytes()]).decode()


def _cleaned(known: NgramSet, text: str) -> str:
    while True:
        data = np.frombuffer(text.encode(), np.uint8)
        w = T.Words(data, np.array([0, len(data)]), T.ALNUM_WORDS)
        first, last, _ = known.hits(data, w)
        if not len(first):
            return text
        text = _cut(data, w, first, last)


#: DuckDB SQL for ``contamination`` with windows of 10 words.
ORACLE = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
iv as (select distinct item_id, k, array_to_string(w[s:s + k - 1], ' ') as g from (select item_id, w, least(len(w), 10) as k, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from iw where len(w) > 0)),
ks as (select distinct k from iv),
dv as (select doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') as g from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s from dw, ks where len(w) >= k)),
hit as (select doc_id, dv.k, s, item_id from dv join iv using (k, g)),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + k)) as p from hit) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as j from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by 1)
select dw.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(j, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join pos using (doc_id) left join its using (doc_id)
"""
