"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words; each passage is
encoded by byte frequencies, hashed byte pairs and repetition.  A gated
attention network (trained in numpy on document labels alone) weights the
passages, and the weighted representation is scored.

The network is fitted on a bounded sample of labelled documents
(``sample_docs`` of each label), whatever their length; of a document of more
than ``sample_passages`` passages it learns from so many, drawn at random
(with a seed) over the whole text.  Every whole text is scored.

Defined results: null, empty and wordless texts are one passage without
features and get its score; null labels are never learnt from; repeated rows
are scored each; without labels the score is 0.5; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import crc_mod, keyed, sampled

PASSAGE_WORDS = 64
PAIR_BUCKETS = 192
FEATURES = 129 + PAIR_BUCKETS + 6
HIDDEN, GATE = 24, 12
SAMPLE_DOCS = 1500
SAMPLE_PASSAGES = 400
HOLDOUT = (3, 1)
EPOCHS = 12
RATE = 0.01


def passages(data: np.ndarray, words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, number of passages by document)."""
    size = np.diff(words.by_doc)
    n = np.maximum(1, -(-size // PASSAGE_WORDS))
    first = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(size)), size)
    of_word = first[doc] + (np.arange(len(doc)) - words.by_doc[doc]) // PASSAGE_WORDS
    total = int(n.sum())
    x = np.zeros((total, FEATURES), np.float32)
    if len(doc):
        # bytes from a passage's first word on belong to it
        begins = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]])
        span = np.diff(np.r_[words.start[begins], len(data)])
        of_byte = np.repeat(of_word[begins], span)
        own = data[words.start[begins[0]]:]
        table = np.minimum(np.arange(256), 128)
        x[:, :129] = np.bincount(of_byte * 129 + table[own], minlength=total * 129).reshape(total, 129)
        pair = ((own[:-1].astype(np.uint32) * np.uint32(2654435761) ^ own[1:].astype(np.uint32) * np.uint32(40503)) >> np.uint32(8)) % np.uint32(PAIR_BUCKETS)
        x[:, 129:129 + PAIR_BUCKETS] = np.bincount(of_byte[:-1] * PAIR_BUCKETS + pair, minlength=total * PAIR_BUCKETS).reshape(total, PAIR_BUCKETS)
        x[:, :129 + PAIR_BUCKETS] = np.sqrt(x[:, :129 + PAIR_BUCKETS] / np.maximum(1, np.bincount(of_byte, minlength=total))[:, None])
        n_words = np.maximum(1, np.bincount(of_word, minlength=total))
        h = words.hash
        for k, lag in enumerate((1, 2, 3)):
            same = np.zeros(len(h), bool)
            same[lag:] = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
            x[:, 129 + PAIR_BUCKETS + k] = np.bincount(of_word[same], minlength=total) / n_words
        x[:, -3] = np.log1p(n_words) / 4
        x[:, -2] = np.bincount(of_word, words.end - words.start, total) / n_words / 8
        distinct = np.unique(np.stack([of_word.astype(np.uint64), h]), axis=1)[0].astype(np.int64) if len(h) < 1000 else _distinct(of_word, h)
        x[:, -1] = np.bincount(distinct, minlength=total) / n_words
    return x, n


def _distinct(of_word: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The passage of each distinct (passage, word)."""
    return (np.unique((of_word.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))) >> np.uint64(40)).astype(np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionMil:
    """Gated attention over encoded passages."""

    def __init__(self, features: int = FEATURES, seed: int = 3):
        rng = np.random.default_rng(seed)
        f = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.w = {"e": f(features, HIDDEN), "eb": np.zeros(HIDDEN, np.float32), "v": f(HIDDEN, GATE), "u": f(HIDDEN, GATE), "a": f(GATE, 1), "c": f(HIDDEN, 1), "b": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)
        self.m = {k: np.zeros_like(x) for k, x in self.w.items()}
        self.s = {k: np.zeros_like(x) for k, x in self.w.items()}
        self.t = 0

    def forward(self, x: np.ndarray, n: np.ndarray):
        """Scores of bags of ``n`` rows each, and what the gradient needs."""
        w = self.w
        x = (x - self.mean) / self.scale
        at = np.cumsum(n) - n
        bag = np.repeat(np.arange(len(n)), n)
        h = np.tanh(x @ w["e"] + w["eb"])
        tv, su = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        a = (tv * su @ w["a"])[:, 0]
        a = np.exp(a - np.maximum.reduceat(a, at)[bag])
        a = a / np.add.reduceat(a, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        p = sigmoid((z @ w["c"])[:, 0] + w["b"][0])
        return p, (x, at, bag, h, tv, su, a, z)

    def learn(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, rate: float, decay: float = 1e-4):
        w = self.w
        p, (x, at, bag, h, tv, su, a, z) = self.forward(x, n)
        d = ((p - y) / len(y)).astype(np.float32)[:, None]
        g = {"c": z.T @ d, "b": d.sum(0)}
        dz = (d @ w["c"].T)[bag]
        dh = a[:, None] * dz
        da = (dz * h).sum(1)
        da = a * (da - np.add.reduceat(a * da, at)[bag])
        g["a"] = (tv * su).T @ da[:, None]
        dg = da[:, None] @ w["a"].T
        dv, du = dg * su * (1 - tv * tv), dg * tv * su * (1 - su)
        g["v"], g["u"] = h.T @ dv, h.T @ du
        dh = (dh + dv @ w["v"].T + du @ w["u"].T) * (1 - h * h)
        g["e"], g["eb"] = x.T @ dh, dh.sum(0)
        self.t += 1
        for k, grad in g.items():
            grad = grad + decay * w[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * grad
            self.s[k] = 0.99 * self.s[k] + 0.01 * grad * grad
            w[k] = (w[k] - rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.s[k] / (1 - 0.99 ** self.t)) + 1e-7)).astype(np.float32)


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES) -> AttentionMil | None:
    """Learn from rows (text, label 0 or 1); ``sample_docs`` of each label."""

    def drawn(x: np.ndarray) -> np.ndarray:
        """A document's passages, or a seeded choice among all of them."""
        if len(x) <= sample_passages:
            return x
        seed = zlib.crc32(x[:64].tobytes() + x[-64:].tobytes(), len(x))
        return x[np.sort(np.random.default_rng(seed).choice(len(x), sample_passages, replace=False))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, out = batch.column("label").to_pylist(), []
            data, offs = T.utf8(batch.column("text"))
            for i, j in T.slices(offs):
                own = data[offs[i]:offs[j]]
                x, n = passages(own, T.Words(own, offs[i:j + 1] - offs[i], T.SPACE_WORDS))
                at = np.cumsum(n) - n
                out += [(y[i + k], drawn(x[at[k]:at[k] + n[k]]).astype("<f2").tobytes()) for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], ["label", "x"])

    sample = sorted(tuple(r) for r in labelled.select("label", "text").mapInArrow(run, "label int, x binary").toLocalIterator())
    if not sample:
        return None
    bags = [np.frombuffer(x, "<f2").reshape(-1, FEATURES) for _, x in sample]
    y = np.array([r[0] for r in sample], np.float32)
    rng, model = np.random.default_rng(9), AttentionMil()
    some = np.concatenate([bags[k] for k in rng.permutation(len(bags))[:500]]).astype(np.float32)
    model.mean, model.scale = some.mean(0), some.std(0) + 0.02
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for s in range(0, len(order), 32):
            part = order[s:s + 32]
            model.learn(np.concatenate([bags[k] for k in part]).astype(np.float32), np.array([len(bags[k]) for k in part]), y[part], RATE * (1 - epoch / EPOCHS))
    return model


def scored(docs: DataFrame, model: AttentionMil | None) -> DataFrame:
    """Rows (doc_id, text, held_out) with score in place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            data, offs = T.utf8(batch.column("text"))
            for i, j in T.slices(offs, 1 << 20) if model is not None else ():
                own = data[offs[i]:offs[j]]
                x, n = passages(own, T.Words(own, offs[i:j + 1] - offs[i], T.SPACE_WORDS))
                score[i:j] = model.forward(x, n)[0]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")


def quality(documents: DataFrame, labels: DataFrame, holdout: tuple[int, int] = HOLDOUT, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    docs = keyed(documents, id_col, text_col).drop("row_key")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (crc_mod("doc_id", holdout[0]) != holdout[1]))
    # both labels by the rate of the rarer one would move the 0.5 mark: one rate for all
    picked = sampled(known.withColumn("all", F.lit(1)), "all", 2 * sample_docs, 23).drop("all")
    model = train(docs.join(F.broadcast(picked), "doc_id"), sample_docs)
    out = scored(docs.withColumn("held_out", crc_mod("doc_id", holdout[0]) == holdout[1]), model)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
