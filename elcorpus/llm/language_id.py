"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader and
elastic-net penalties, then calibrated by one temperature.

Document frequencies are counted over all training documents; the regression
is fitted on a bounded sample (``per_lang`` documents of each language), as
sparse counts.  Predictions read the whole text and nothing else.

Defined results: null texts and texts without a letter are ``und`` with
score 0, and so is everything if no language was learnt; rows with a null
lang are never learnt from; repeated rows are judged each; an empty table
gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from elcorpus.llm import textops as T
from elcorpus.llm.common import crc_mod, keyed, sampled, ship

ORDERS = (1, 2, 3)
BUCKET_BITS = 14
PER_LANG = 400
HOLDOUT = (4, 2)
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
#: Share of the sample kept for the temperature.
CALIBRATION = 0.25
#: Documents scored by one matrix product.
ROWS = 64
ADDERS = 16

_folded = None


def folded_points() -> np.ndarray:
    """Code point -> lower-cased letter, or a blank for all else."""
    global _folded
    if _folded is None:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _folded = t
    return _folded


def gram_counts(texts: list[str | None]) -> Iterator[np.ndarray | None]:
    """N-gram counts by bucket of each text; None without letters."""
    table, size = folded_points(), 1 << BUCKET_BITS
    for text in texts:
        points = table[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        if not (points != 32).any():
            yield None
            continue
        counts = np.zeros(size, np.int64)
        for s in range(0, len(points), 1 << 20):  # a very long text in parts
            part = np.r_[np.uint64(32), points[s:s + (1 << 20) + 2], np.uint64(32)] if s == 0 else points[s - 1:s + (1 << 20) + 2]
            code = np.zeros(len(part), np.uint64)
            for n in range(1, max(ORDERS) + 1):
                code = (code[:len(part) - n + 1] * np.uint64(0x110001) + part[n - 1:])
                if n in ORDERS:
                    h = code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    counts += np.bincount((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=size)
        yield counts


class Ftrl:
    """Follow-the-regularised-leader for a softmax over sparse inputs."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, idx: np.ndarray, x: np.ndarray, y: int):
        idx, x = np.r_[idx, len(self.z) - 1], np.r_[x, 1.0]  # the last row is the bias
        w = self.weights(idx)
        p = softmax((x @ w)[None])[0]
        p[y] -= 1
        g = x[:, None] * p
        root = np.sqrt(self.n[idx] + g * g)
        self.z[idx] += g - (root - np.sqrt(self.n[idx])) / ALPHA * w
        self.n[idx] += g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest log loss."""
    if len(y) == 0:
        return 1.0
    grid = np.exp(np.linspace(np.log(0.1), np.log(5), 120))
    losses = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


class LanguageModel:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, t: float):
        self.langs, self.idf, self.weights, self.t = langs, idf, weights, t

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = tfidf(counts, self.idf)
        p = softmax((x @ self.weights[:-1] + self.weights[-1]) / self.t)
        return p.argmax(1), p.max(1)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    return x / np.maximum(1e-12, np.sqrt((x * x).sum(-1, keepdims=True)))


def _frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each bucket), over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, mark = np.zeros(1 << BUCKET_BITS, np.int64), 0, 0
        for batch in batches:
            for counts in gram_counts(batch.column("text").to_pylist()):
                if counts is not None:
                    df += counts > 0
                    n += 1
            mark = (mark * 31 + int(df.sum())) % ADDERS
        yield pa.RecordBatch.from_arrays([pa.array([mark], pa.int32()), pa.array([n], pa.int64()), pa.array([df.astype("<i8").tobytes()], pa.binary())], ["g", "n", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            n += sum(batch.column("n").to_pylist())
            for x in batch.column("df"):
                df = df + np.frombuffer(x.as_buffer(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    n, df = 0, np.zeros(1 << BUCKET_BITS, np.int64)
    for r in docs.select("text").mapInArrow(run, "g int, n long, df binary").repartition(ADDERS, "g").mapInArrow(add, "n long, df binary").toLocalIterator():
        n, df = n + r["n"], df + np.frombuffer(r["df"], "<i8")
    return n, df


def train(docs: DataFrame, per_lang: int = PER_LANG) -> LanguageModel:
    """Learn from rows (doc_id, text, lang)."""
    n, df = _frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, counts in zip(batch.column("lang").to_pylist(), gram_counts(batch.column("text").to_pylist()), strict=True):
                if counts is not None:
                    idx = np.flatnonzero(counts)
                    out.append((lang, idx.astype("<u2").tobytes(), counts[idx].astype("<f4").tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.binary()), strict=True)], ["lang", "idx", "counts"])

    picked = sampled(docs.select("doc_id", "text", "lang"), "lang", per_lang, 11)
    sample = sorted(tuple(r) for r in picked.mapInArrow(run, "lang string, idx binary, counts binary").collect())
    langs = sorted({r[0] for r in sample})
    rng = np.random.default_rng(5)
    data = []
    for lang, idx, counts in sample:
        idx = np.frombuffer(idx, "<u2").astype(np.int64)
        x = np.frombuffer(counts, "<f4") * idf[idx]
        data.append((idx, x / max(1e-12, np.sqrt((x * x).sum())), langs.index(lang)))
    order = rng.permutation(len(data))
    keep = int(len(data) * CALIBRATION)
    model = Ftrl(1 << BUCKET_BITS, len(langs))
    for _ in range(EPOCHS):
        for k in rng.permutation(order[keep:]).tolist():
            model.learn(*data[k])
    w = model.weights()
    held = [data[k] for k in order[:keep].tolist()]
    logits = np.array([x @ w[idx] + w[-1] for idx, x, _ in held]).reshape(len(held), len(langs))
    return LanguageModel(langs, idf, w, temperature(logits, np.array([y for _, _, y in held], np.int64)))


def predictions(documents: DataFrame, model: LanguageModel, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``documents`` with the predicted language and its probability, in new
    columns of these names."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            rows, block = [], []

            def flush():
                if rows and model.langs:
                    best, p = model.predict(np.stack(block))
                    for r, b in zip(rows, best.tolist(), strict=True):
                        langs[r] = model.langs[b]
                    score[rows] = p
                rows.clear()
                block.clear()

            for s in range(0, batch.num_rows, ROWS):
                for r, counts in enumerate(gram_counts(batch.column(text_col).slice(s, ROWS).to_pylist()), s):
                    if counts is not None:
                        rows.append(r)
                        block.append(counts)
                flush()
            yield batch.append_column(names[0], pa.array(langs, pa.string())).append_column(names[1], pa.array(score))

    schema = StructType([*documents.schema, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return documents.mapInArrow(run, schema)


def languages(documents: DataFrame, holdout: tuple[int, int] = HOLDOUT, per_lang: int = PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    docs = keyed(documents, id_col, text_col).drop("row_key")
    held = crc_mod("doc_id", holdout[0]) == holdout[1]
    learn = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & ~held)
    return predictions(docs.withColumn("held_out", held), train(learn, per_lang)).select("doc_id", "held_out", "lang_pred", "score")
