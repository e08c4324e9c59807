"""Toxicity by a factorization machine over hashed terms.

A text is read in windows of two neighbouring blocks of BLOCK_WORDS words.  A
window is the set of its terms (folded words, hashed to 2**HASH_BITS places);
its logit is a bias, a weight for every term and the inner product of the
factors of every two terms, so that an insult beside a group's name can count
for more (or less) than both alone.  The text's logit is that of its worst
window, so a long text is not judged by its length.

Weights are learnt with follow-the-regularised-leader, which leaves most of
them 0; factors with adaptive steps that shrink whole rows to 0.  Terms with
neither are not kept.  Only terms of LEAST_DOCS documents or more are learnt,
on a bounded sample of labelled documents (``sample_docs`` of each label); of
a document of more than SAMPLE_BLOCKS blocks it learns from so many
neighbouring pairs, drawn with a seed over the whole text.  A part of the
sample is left out and gives the logits' scale and offset, each label weighted
by its share in all labelled rows.  Every whole text is scored.

Defined results: null, empty and wordless texts have one window without terms
and get the bias' score; null labels and ids with both labels are never
learnt from; repeated rows are scored each; without documents of both labels
the score is the label's own share (0 without any); an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import crc_mod, keyed, sampled

HASH_BITS = 26
BLOCK_WORDS = 24
SAMPLE_DOCS, SAMPLE_BLOCKS, LEAST_DOCS = 2500, 96, 3
HOLDOUT = (5, 0)
FACTORS, EPOCHS, BATCH = 8, 12, 32
#: Epochs before the factors come in: they learn what the weights miss.
ADDITIVE = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.01
RATE, SHRINK, START = 0.3, 0.05, 0.05
#: Rows of factors shorter than this are what is left of their start.
LEAST_NORM = 0.3
#: Share of the sample that is kept for the calibration.
CALIBRATION = 0.2


def terms(words: T.Words) -> np.ndarray:
    """The place of every word."""
    return (words.hash >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def windows(block: np.ndarray, first: np.ndarray, n_blocks: np.ndarray, doc: np.ndarray, term: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct window * size + term.  Document d has the windows
    first[d] .. first[d] + max(1, n_blocks[d] - 1) - 1; each word is in the
    windows that begin with its block and with the one before."""
    last = np.maximum(1, n_blocks[doc] - 1) - 1
    here, before = block <= last, block > 0
    key = np.r_[((first[doc] + block) * size + term)[here], ((first[doc] + block - 1) * size + term)[before]]
    return np.unique(key)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i]:at[i + 1]] (empty ones too)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


class FactorizationMachine:
    """Bias, weights and factors of the terms ``places`` (sorted)."""

    def __init__(self, places: np.ndarray, factors: int = FACTORS, seed: int = 17):
        n = len(places)
        self.places, self.bias = places, 0.0
        self.scale, self.offset = 1.0, 0.0
        self.w = np.zeros(n)
        self.v = np.random.default_rng(seed).normal(0, START, (n, factors))
        self.z, self.n = np.zeros(n), np.zeros(n)
        self.n_v, self.n_b = np.ones(n), 1e-6

    def logits(self, term: np.ndarray, at: np.ndarray, pairs: bool = True):
        """Logits of windows with the terms term[at[i]:at[i + 1]]."""
        z = self.bias + sums(self.w[term], at)
        if not pairs:
            return z, None, None
        v = self.v[term]
        s = sums(v, at)
        return z + 0.5 * ((s * s).sum(1) - sums((v * v).sum(1), at)), s, v

    def learn(self, term: np.ndarray, at: np.ndarray, doc_at: np.ndarray, y: np.ndarray, sharp: float, pairs: bool = True):
        """One step over documents with the windows doc_at[d] .. doc_at[d + 1];
        the worst windows of each bear its error."""
        z, s, v = self.logits(term, at, pairs)
        n = np.diff(doc_at)
        doc = np.repeat(np.arange(len(n)), n)
        a = np.exp(np.clip(sharp * (z - np.maximum.reduceat(z, doc_at[:-1])[doc]), -60, 0))
        a /= np.add.reduceat(a, doc_at[:-1])[doc]
        error = sigmoid(np.add.reduceat(a * z, doc_at[:-1])) - y
        dz = error[doc] * a
        of = np.repeat(dz, np.diff(at))
        used, place = np.unique(term, return_inverse=True)
        g = np.bincount(place, of, len(used))
        grown = np.sqrt(self.n[used] + g * g)
        self.z[used] += g - (grown - np.sqrt(self.n[used])) / ALPHA * self.w[used]
        self.n[used] += g * g
        zu = self.z[used]
        self.w[used] = np.where(np.abs(zu) > L1, -(zu - np.sign(zu) * L1) / ((BETA + grown) / ALPHA + L2), 0.0)
        gb = float(dz.sum())
        self.n_b += gb * gb
        self.bias -= 0.3 * gb / math.sqrt(self.n_b)
        if not pairs:
            return
        gv = of[:, None] * (np.repeat(s, np.diff(at), axis=0) - v)
        gv = np.stack([np.bincount(place, gv[:, f], len(used)) for f in range(gv.shape[1])], 1)
        self.n_v[used] += (gv * gv).sum(1)
        step = (RATE / np.sqrt(self.n_v[used]))[:, None]
        vu = self.v[used] - step * gv
        norm = np.sqrt((vu * vu).sum(1, keepdims=True))
        self.v[used] = vu * np.maximum(0.0, 1 - SHRINK * step / np.maximum(norm, 1e-12))

    def kept(self) -> FactorizationMachine:
        """Without the terms that count for nothing."""
        self.v[np.sqrt((self.v * self.v).sum(1)) < LEAST_NORM] = 0.0
        keep = (self.w != 0) | (self.v != 0).any(1)
        self.places, self.w, self.v = self.places[keep], self.w[keep], self.v[keep]
        self.z = self.n = self.n_v = None
        return self

    def scores(self, place: np.ndarray, by_doc: np.ndarray) -> np.ndarray:
        """Probability of every document, of the places of its words."""
        return sigmoid(self.scale * self.worst(place, by_doc) + self.offset)

    def worst(self, place: np.ndarray, by_doc: np.ndarray) -> np.ndarray:
        """The logit of the worst window of every document."""
        size = np.diff(by_doc)
        worst = np.full(len(size), self.bias)
        at = np.searchsorted(self.places, place)
        hit = np.flatnonzero(self.places[np.minimum(at, len(self.places) - 1)] == place) if len(self.places) else np.zeros(0, np.int64)
        if len(hit):
            doc = np.searchsorted(by_doc, hit, "right") - 1
            n_blocks = -(-size // BLOCK_WORDS)
            many = np.maximum(1, n_blocks - 1)
            first = np.cumsum(many) - many
            key = windows((hit - by_doc[doc]) // BLOCK_WORDS, first, n_blocks, doc, at[hit], len(self.places))
            win, term = key // len(self.places), key % len(self.places)
            begins = np.flatnonzero(np.r_[True, win[1:] != win[:-1]])
            z = self.logits(term, np.r_[begins, len(win)])[0]
            of = np.searchsorted(first, win[begins], "right") - 1
            # a window without known terms has the bias; only a text all of
            # whose windows have some may fall below it
            best = np.full(len(size), -np.inf)
            np.maximum.at(best, of, z)
            whole = np.bincount(of, minlength=len(size)) == many
            worst = np.where(whole, best, np.maximum(best, worst))
        return worst

    def calibrate(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray):
        """Scale and offset of the smallest weighted log loss (by Newton
        steps; targets a little inside 0 and 1, so that it has one)."""
        z = self.worst(np.concatenate(docs), np.cumsum([0, *(len(d) for d in docs)]))
        goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        x, b = np.stack([z, np.ones(len(z))], 1), np.array([1.0, 0.0])
        for _ in range(40):
            p = sigmoid(x @ b)
            g = x.T @ (weight * (p - goal)) + 1e-3 * (b - [1.0, 0.0])
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            b = b - np.clip(np.linalg.solve(h, g), -2, 2)
        if b[0] > 0:
            self.scale, self.offset = float(b[0]), float(b[1])


def fitted(docs: list[np.ndarray], y: np.ndarray, least_docs: int = LEAST_DOCS, epochs: int = EPOCHS) -> FactorizationMachine:
    """Learn from the places of the words of each document."""
    distinct, count = np.unique(np.concatenate([np.unique(d) for d in docs] or [np.zeros(0, np.int64)]), return_counts=True)
    places = distinct[count >= least_docs]
    model = FactorizationMachine(places)
    share = min(0.99, max(0.01, float(y.mean())))
    model.bias = math.log(share / (1 - share))
    rng = np.random.default_rng(29)
    size = max(1, len(places))
    ready = []
    for d in docs:
        at = np.searchsorted(places, d)
        ok = places[np.minimum(at, len(places) - 1)] == d if len(places) else np.zeros(len(d), bool)
        n_blocks = np.array([-(-len(d) // BLOCK_WORDS)])
        n = max(1, int(n_blocks[0]) - 1)
        key = windows(np.flatnonzero(ok) // BLOCK_WORDS, np.zeros(1, np.int64), n_blocks, np.zeros(int(ok.sum()), np.int64), at[ok], size)
        ready.append(((key % size).astype(np.int32), np.searchsorted(key, np.arange(n + 1) * size)))
    for epoch in range(epochs):
        sharp = 1.0 + 6.0 * epoch / epochs if epoch < epochs * 2 // 3 else 60.0
        order = rng.permutation(len(ready))
        for s in range(0, len(order), BATCH):
            part = [ready[k] for k in order[s:s + BATCH]]
            term = np.concatenate([p[0] for p in part])
            n = np.array([len(p[1]) - 1 for p in part])
            begin = np.cumsum([0, *(len(p[0]) for p in part)])
            at = np.r_[np.concatenate([p[1][:-1] + b for p, b in zip(part, begin, strict=False)]), begin[-1]]
            model.learn(term, at, np.r_[0, np.cumsum(n)], y[order[s:s + BATCH]], sharp, epoch >= ADDITIVE)
    return model.kept()


def drawn(place: np.ndarray, blocks: int = SAMPLE_BLOCKS) -> np.ndarray:
    """All words, or of a longer text ``blocks`` blocks in pairs of neighbours."""
    pair = 2 * BLOCK_WORDS
    n = -(-len(place) // pair)
    if 2 * n <= blocks:
        return place
    pick = np.sort(np.random.default_rng(zlib.crc32(place.tobytes())).choice(n, blocks // 2, replace=False))
    return np.concatenate([place[i * pair:(i + 1) * pair] for i in pick])


def train(labelled: DataFrame, rates: dict[int, float] | None = None, sample_blocks: int = SAMPLE_BLOCKS) -> FactorizationMachine | None:
    """Learn from a bounded sample of rows (text, label 0 or 1); ``rates`` has
    the share of each label's rows that was drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, j, words in T.texts_of(batch, T.ALNUM_WORDS):
                place = terms(words).astype("<u4")
                out += [drawn(place[a:b], sample_blocks).tobytes() for a, b in zip(words.by_doc[:-1], words.by_doc[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.binary())], ["label", "x"])

    sample = sorted(tuple(r) for r in labelled.select("label", "text").mapInArrow(run, "label int, x binary").toLocalIterator())
    y = np.array([r[0] for r in sample], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    docs = [np.frombuffer(x, "<u4").astype(np.int64) for _, x in sample]
    left_out = np.random.default_rng(41).random(len(y)) < CALIBRATION
    if len(set(y[left_out].tolist())) < 2 or len(set(y[~left_out].tolist())) < 2:
        return fitted(docs, y)
    model = fitted([d for d, out in zip(docs, left_out, strict=True) if not out], y[~left_out])
    weight = np.array([1 / (rates or {}).get(int(v), 1.0) for v in y[left_out]])
    model.calibrate([d for d, out in zip(docs, left_out, strict=True) if out], y[left_out], weight / weight.mean())
    return model


def scored(docs: DataFrame, model: FactorizationMachine | None, without: float = 0.0) -> DataFrame:
    """Rows (doc_id, text, held_out) with score in place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = np.full(batch.num_rows, without)
            if model is not None:
                for i, j, words in T.texts_of(batch, T.ALNUM_WORDS):
                    score[i:j] = model.scores(terms(words), words.by_doc)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")


def toxicity(documents: DataFrame, labels: DataFrame, holdout: tuple[int, int] = HOLDOUT, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    docs = keyed(documents, id_col, text_col).drop("row_key")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (crc_mod("doc_id", holdout[0]) != holdout[1]))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    count = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = sampled(known, "label", sample_docs, 37)
    model = train(docs.join(F.broadcast(picked), "doc_id"), {v: min(1.0, sample_docs / n) for v, n in count.items()})
    share = count.get(1, 0) / max(1, sum(count.values()))
    out = scored(docs.withColumn("held_out", crc_mod("doc_id", holdout[0]) == holdout[1]), model, share)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
