"""Text scores by a log-bilinear language model, trained in numpy with
noise-contrastive estimation.

Counts of all training words are one grouped table.  The model predicts the
``model_words`` most frequent words, the end and "any other word" from the
two words before; another word's share is its add-one count among the others,
so the log-probabilities are normalised over all words and one unseen word.

Every training task makes a pass of stochastic steps over its own documents,
from common parameters, with noise words shared by a minibatch; the
parameters are then averaged by the number of tokens, ``rounds`` times.  They
have a fixed size, and so have the counts of the end and of the ``head_words``
most frequent words, which are broadcast.  The counts of the other words reach a document
by a join.

Defined results: null, empty and wordless texts consist of the end alone;
repeated rows are learnt and scored each; without training documents the
model is uniform; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import crc_mod, keyed, written

MODEL_WORDS = 1022
HEAD_WORDS = 1 << 17
DIMENSIONS = 16
NOISE = 64
BATCH = 2048
RATE = 0.15
ROUNDS = 1
HOLDOUT = (7, 2)

OTHER, END = 0, 1  # model ids; words follow
END_HASH = int(T.mix(np.array([0x1234567], np.uint64))[0])
#: Groups in which parameters are added up.
ADDERS = 16


def _counted(docs: DataFrame) -> DataFrame:
    """(h, c): training counts of every word and of the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            h = np.concatenate([x for x, _ in held])
            c = np.concatenate([x for _, x in held])
            unique, at = np.unique(h, return_inverse=True)
            return unique, np.bincount(at, c, len(unique)).astype(np.int64)

        def out(h, c):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        for batch in batches:
            for i, j, words in T.texts_of(batch, T.SPACE_WORDS):
                h, c = np.unique(words.hash, return_counts=True)
                held.append((np.r_[h, np.uint64(END_HASH)], np.r_[c, j - i]))
                size += len(h) + 1
            if size > 600_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 300_000:  # a task's memory stays bounded
                    yield out(*held.pop())
                    size = 0
        if held:
            yield out(*merged())

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Counts of the head, model ids and totals."""

    def __init__(self, head: list[tuple[int, int]], n: int, v: int, model_words: int):
        h = np.array([x for x, _ in head], np.int64).view(np.uint64)
        c = np.array([x for _, x in head], np.int64)
        order = np.argsort(h)
        rank = np.flatnonzero(h != np.uint64(END_HASH))[:model_words]
        ids = np.zeros(len(h), np.int64)
        ids[rank] = np.arange(len(rank)) + 2
        ids[h == np.uint64(END_HASH)] = END
        self.hash, self.count, self.ids = h[order], c[order], ids[order]
        self.size = len(rank) + 2
        inside = ids > 0
        self.n, self.v = n, v
        self.other_total = n - int(c[inside].sum()) + v - int(inside.sum()) + 1
        unigram = np.ones(self.size)
        np.add.at(unigram, ids[inside], c[inside])
        unigram[OTHER] += n - c[inside].sum()
        self.unigram = unigram / unigram.sum()

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(model id, count, whether in the head) of word hashes."""
        if len(self.hash) == 0:
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        known = self.hash[at] == h
        return np.where(known, self.ids[at], OTHER), np.where(known, self.count[at], 0), known


def sequences(words: T.Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(model ids with each document's end, the id before, the one before
    that, the document's number) for a run of documents."""
    n_docs = len(words.by_doc) - 1
    ends = words.by_doc[1:] + np.arange(n_docs)
    out = np.full(len(ids) + n_docs, END, np.int64)
    place = np.ones(len(out), bool)
    place[ends] = False
    out[place] = ids
    starts = words.by_doc[:-1] + np.arange(n_docs)
    one, two = np.r_[END, out[:-1]], np.r_[END, END, out[:-2]][:len(out)]
    two[starts] = END
    two[np.minimum(starts + 1, ends)] = END
    one[starts] = END
    return out, one, two, np.repeat(np.arange(n_docs), ends - starts + 1)


class LogBilinear:
    """score(w | u, v) = (c1 * r[v] + c2 * r[u]) . q[w] + b[w]."""

    def __init__(self, unigram: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 7):
        rng = np.random.default_rng(seed)
        m = len(unigram)
        self.unigram = unigram
        self.w = {"r": rng.normal(0, 0.3, (m, dimensions)), "q": rng.normal(0, 0.1, (m, dimensions)), "b": np.log(unigram), "c": np.stack([np.ones(dimensions), np.full(dimensions, 0.5)])}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.square = {k: np.full(v.shape, 1e-2, np.float32) for k, v in self.w.items()}

    def _step(self, k: str, grad: np.ndarray, rate: float):
        self.square[k] += grad * grad
        self.w[k] += rate * grad / np.sqrt(self.square[k])

    def learn(self, ids, one, two, rng, rate: float = RATE, noise: int = NOISE):
        """One minibatch of noise-contrastive estimation (Adagrad)."""
        w, n, m = self.w, len(ids), len(self.unigram)
        bad = np.minimum(np.searchsorted(self.cumulative, rng.random(noise)), m - 1)
        shift = np.log(noise * self.unigram).astype(np.float32)
        r1, r2, q = w["r"][one], w["r"][two], w["q"][ids]
        ctx = w["c"][0] * r1 + w["c"][1] * r2
        good = 1 / (1 + np.exp(np.einsum("ij,ij->i", ctx, q) + w["b"][ids] - shift[ids]))
        s = ctx @ w["q"][bad].T
        s += w["b"][bad] - shift[bad]
        false = -1 / (1 + np.exp(-s))
        d_ctx = good[:, None] * q + false @ w["q"][bad]
        gq, gb, gr = np.zeros_like(w["q"]), np.zeros_like(w["b"]), np.zeros_like(w["r"])
        for d in range(gq.shape[1]):
            gq[:, d] = np.bincount(ids, good * ctx[:, d], m)
            gr[:, d] = np.bincount(one, d_ctx[:, d] * w["c"][0, d], m) + np.bincount(two, d_ctx[:, d] * w["c"][1, d], m)
        np.add.at(gq, bad, false.T @ ctx)
        gb += np.bincount(ids, good, m).astype(np.float32)
        np.add.at(gb, bad, false.sum(0))
        gc = np.stack([(d_ctx * r1).sum(0), (d_ctx * r2).sum(0)])
        for k, g in (("q", gq), ("r", gr), ("b", gb), ("c", gc)):
            self._step(k, g / n, rate * (0.1 if k == "c" else 1))

    @property
    def cumulative(self):
        return np.cumsum(self.unigram)

    def pack(self) -> bytes:
        return np.concatenate([self.w[k].ravel() for k in ("r", "q", "b", "c")]).astype("<f8").tobytes()

    def unpack(self, flat: np.ndarray):
        at = 0
        for k in ("r", "q", "b", "c"):
            size = self.w[k].size
            self.w[k] = flat[at:at + size].reshape(self.w[k].shape).astype(np.float32)
            at += size

    def scorer(self):
        """A function of (ids, one, two): log-probabilities.  Normalisers of
        contexts are made in batched products, once for each context."""
        m = len(self.unigram)
        norm = np.full(m * m, np.nan, np.float32)
        w = self.w

        def score(ids, one, two):
            code = two * m + one
            new = np.unique(code)
            new = new[np.isnan(norm[new])]
            for s in range(0, len(new), 4096):
                part = new[s:s + 4096]
                x = (w["c"][0] * w["r"][part % m] + w["c"][1] * w["r"][part // m]) @ w["q"].T
                x += w["b"]
                top = x.max(1)
                norm[part] = top + np.log(np.exp(x - top[:, None]).sum(1))
            ctx = w["c"][0] * w["r"][one] + w["c"][1] * w["r"][two]
            return np.einsum("ij,ij->i", ctx, w["q"][ids]).astype(np.float64) + w["b"][ids] - norm[code]

        return score


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """Passes of all tasks over their documents, averaged after each."""
    model = LogBilinear(vocabulary.unigram)
    sc = docs.sparkSession.sparkContext
    for round_ in range(rounds):
        shared = sc.broadcast((vocabulary, model))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, round_=round_) -> Iterator[pa.RecordBatch]:
            vocabulary, start = shared.value
            own = LogBilinear(vocabulary.unigram)
            own.unpack(np.frombuffer(start.pack(), "<f8"))
            rng, n, mark, wait = np.random.default_rng(round_), 0, 0, []
            for batch in batches:
                for _, _, words in T.texts_of(batch, T.SPACE_WORDS):
                    mark ^= zlib.crc32(words.hash[:64].tobytes())
                    unique, at = np.unique(words.hash, return_inverse=True)
                    x = np.stack(sequences(words, vocabulary.look(unique)[0][at])[:3])
                    x = x[:, rng.permutation(x.shape[1])]
                    if wait:
                        x = np.concatenate([*wait, x], 1)
                    full = x.shape[1] // BATCH * BATCH
                    for s in range(0, full, BATCH):
                        own.learn(*x[:, s:s + BATCH], rng)
                    n += full
                    wait = [x[:, full:]]
            if wait and wait[0].shape[1]:
                own.learn(*wait[0], rng)
                n += wait[0].shape[1]
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([mark % ADDERS], pa.int32()), pa.array([n], pa.int64()), pa.array([(np.frombuffer(own.pack(), "<f8") * n).tobytes()], pa.binary())], ["g", "n", "w"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, None
            for batch in batches:
                for k, w in zip(batch.column("n").to_pylist(), batch.column("w"), strict=True):
                    own = np.frombuffer(w.as_buffer(), "<f8")
                    n, total = n + k, own if total is None else total + own
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "w"])

        got = docs.select("text").mapInArrow(run, "g int, n long, w binary").repartition(ADDERS, "g").mapInArrow(add, "n long, w binary")
        n, total = 0, None
        for r in got.toLocalIterator():  # a row for each adder
            own = np.frombuffer(r["w"], "<f8")
            n, total = n + r["n"], own if total is None else total + own
        if n:
            model.unpack(total / n)
    return model


def scores(documents: DataFrame, holdout: tuple[int, int] = HOLDOUT, model_words: int = MODEL_WORDS, head_words: int = HEAD_WORDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base score and the model's score."""
    docs = keyed(documents, id_col, text_col).withColumn("held_out", crc_mod("doc_id", holdout[0]) == holdout[1])
    learn = docs.where(~F.col("held_out"))
    counts = written(_counted(learn), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    is_end = F.col("h") == int(np.array([END_HASH], np.uint64).view(np.int64)[0])
    head = [(r["h"], r["c"]) for r in counts.where(~is_end).orderBy(F.desc("c"), "h").limit(head_words).collect()]
    head += [(r["h"], r["c"]) for r in counts.where(is_end).collect()]  # whatever words are more frequent
    vocabulary = Vocabulary(head, n, v, model_words)
    model = train(learn, vocabulary, rounds)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row_key", "doc_id", "held_out", "h", "tf", "n_tokens", "n_known", "n_other", "base", "other", "lm"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        score = model.scorer()
        end_count = int(vocabulary.look(np.array([END_HASH], np.uint64))[1][0])
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for i, j, words in T.texts_of(batch, T.SPACE_WORDS):
                unique, at = np.unique(words.hash, return_inverse=True)
                ids, count, known = vocabulary.look(unique)
                seq, one, two, doc = sequences(words, ids[at])
                k = j - i
                lm = np.bincount(doc, score(seq, one, two), k) / np.log(10)
                size = np.diff(words.by_doc)
                of_word = np.repeat(np.arange(k), size)
                logs = np.log10(count + 1.0)[at]
                other = (ids == OTHER)[at]
                base = np.bincount(of_word, logs, k) + np.log10(end_count + 1.0)
                sums = base, np.bincount(of_word, logs * other, k), lm
                n_known = np.bincount(of_word, known[at], k).astype(np.int64) + (end_count > 0)
                tail = np.unique(of_word[~known[at]].astype(np.int64) << 32 | at[~known[at]], return_counts=True)
                d, h = tail[0] >> 32, unique[tail[0] & 0xFFFFFFFF].view(np.int64)
                t = len(d)
                row = keys[i:j]
                own = T.mix(row.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)).view(np.int64)  # spreads the documents' own rows
                ints = [np.zeros(t, np.int64)] * 3
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[row, row[d]]), pa.concat_arrays([batch.column("doc_id").slice(i, k), pa.nulls(t, batch.column("doc_id").type)]),
                    pa.concat_arrays([batch.column("held_out").slice(i, k), pa.nulls(t, pa.bool_())]),
                    pa.array(np.r_[own, h]), pa.array(np.r_[np.zeros(k, np.int64), tail[1]]),
                    *[pa.array(np.r_[x.astype(np.int64), z]) for x, z in zip((size + 1, n_known, np.bincount(of_word, other, k)), ints, strict=True)],
                    *[pa.array(np.r_[x, np.zeros(t)]) for x in sums]], names)

    parts = docs.mapInArrow(run, f"row_key long, doc_id {kind}, held_out boolean, h long, tf long, n_tokens long, n_known long, n_other long, base double, other double, lm double")
    joined = parts.join(counts, "h", "left").withColumn("c", F.when(F.col("tf") > 0, F.col("c")))
    more = F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))
    total = joined.groupBy("row_key").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("n_known"), F.sum("n_other").alias("n_other"), F.sum(F.col("base") + more).alias("base"), F.sum(F.col("other") + more).alias("other"), F.sum("lm").alias("lm"))
    return total.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"), (F.col("lm") + F.col("other") - F.col("n_other") * float(np.log10(max(1, vocabulary.other_total)))).alias("score"))
