"""URL filter: block and allow rules first, then gradient-boosted trees on
lexical features.

Features: length, depth, digit ratio, entropy, parameter counts, host shape
and statistics of the host's last one and two labels (rows and share of
blocked URLs among the labelled ones, smoothed).  The suffix statistics are
counted over all labelled URLs in SUFFIX_BUCKETS hashed buckets, so their
table has a fixed size; the trees are fitted on a bounded sample of labelled
URLs (``sample_rows``).

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is judged by its (empty) features; repeated rows are
judged each; without labelled URLs of both kinds everything unruled is
allowed; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from elcorpus.llm.common import sampled, ship

#: (host, path, verdict), fixed values of the query's rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SUFFIX_BUCKETS = 4096
SAMPLE_ROWS = 5000
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.2
#: Pseudo-rows that draw a rare suffix's share to the mean.
SMOOTH = 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(u, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in rules]
    ordered = sorted(zip(rules, fits, strict=True), key=lambda x: -len(x[0][0] + x[0][1]))
    rule = verdict = None
    for (h, p, v), fit in ordered:
        rule = F.when(fit, h + p) if rule is None else rule.when(fit, h + p)
        verdict = F.when(fit, v) if verdict is None else verdict.when(fit, v)
    return rule, verdict


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` (with host, path) and the lexical columns of FEATURES."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    chars = F.split(u, "")
    entropy = F.when(n == 0, 0.0).otherwise(F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(((n - F.length(F.replace(u, c, F.lit("")))) / n) * F.log2((n - F.length(F.replace(u, c, F.lit("")))) / n))))
    digits = n - F.length(F.regexp_replace(u, "[0-9]", ""))
    return urls.select("*", n.cast("double").alias("f_length"), F.length("host").cast("double").alias("f_host"), F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double").alias("f_depth"), F.size(labels).cast("double").alias("f_labels"), (digits / F.greatest(n, F.lit(1))).alias("f_digits"), entropy.alias("f_entropy"), F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("f_params"), (n - F.length(F.translate(u, "-_%", ""))).cast("double").alias("f_marks"), u.contains("#").cast("double").alias("f_fragment"), u.startswith("https").cast("double").alias("f_https"), F.regexp_like("path", F.lit(r"\.[a-z0-9]+$")).cast("double").alias("f_file"), _bucket(F.element_at(labels, -1)).alias("suffix1"), _bucket(F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)))).alias("suffix2"))


FEATURES = ("f_length", "f_host", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params", "f_marks", "f_fragment", "f_https", "f_file")


def _bucket(suffix: Column) -> Column:
    return F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_BUCKETS)).cast("int")


class Boosted:
    """Gradient-boosted trees for a binary label, on binned features."""

    def __init__(self):
        self.edges: list[np.ndarray] = []
        self.trees: list[list[tuple[int, int, float]]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
        bins = self._binned(x)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        raw = np.full(len(y), self.base)
        for _ in range(trees):
            prob = 1 / (1 + np.exp(-raw))
            g, h = y - prob, prob * (1 - prob)
            tree = [(-1, 0, 0.0)] * (2 ** (depth + 1) - 1)  # (feature, bin, value) in heap order
            node = np.zeros(len(y), np.int64)
            for at in range(len(tree)):
                own = np.flatnonzero(node == at)
                if not len(own):
                    continue
                gs, hs = g[own].sum(), h[own].sum()
                best, split = 1e-6, None
                if at < 2 ** depth - 1:
                    for k in range(x.shape[1]):
                        gl = np.cumsum(np.bincount(bins[own, k], g[own], BINS + 1))[:-1]
                        hl = np.cumsum(np.bincount(bins[own, k], h[own], BINS + 1))[:-1]
                        gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                        gain[(hl < 1e-9) | (hs - hl < 1e-9)] = 0
                        if gain.max() > best:
                            best, split = gain.max(), (k, int(gain.argmax()))
                if split is None:
                    tree[at] = (-1, 0, RATE * gs / (hs + 1))
                    raw[own] += tree[at][2]
                else:
                    tree[at] = (*split, 0.0)
                    node[own] = 2 * at + 1 + (bins[own, split[0]] > split[1])
            self.trees.append(tree)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins, raw = self._binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            feature, cut, value = (np.array([t[k] for t in tree]) for k in range(3))
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                right = bins[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(f < 0, node, 2 * node + 1 + right)
            raw += value[node]
        return 1 / (1 + np.exp(-raw))


class UrlModel:
    """Suffix statistics and trees."""

    def __init__(self, stats: np.ndarray, trees: Boosted | None):
        self.stats, self.trees = stats, trees

    def matrix(self, lexical: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        mean = self.stats[..., 1].sum() / max(1.0, self.stats[..., 0].sum())
        cols = [lexical]
        for k, s in enumerate((s1, s2)):
            rows, blocked = self.stats[k, s, 0], self.stats[k, s, 1]
            cols += [np.log1p(rows)[:, None], ((blocked + SMOOTH * mean) / (rows + SMOOTH))[:, None]]
        return np.concatenate(cols, 1)


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Learn from features() rows with a label (1: block)."""
    stats = np.zeros((2, SUFFIX_BUCKETS, 2))
    for k, name in enumerate(("suffix1", "suffix2")):
        for r in labelled.groupBy(name).agg(F.count("*").alias("n"), F.sum("label").alias("b")).collect():  # at most SUFFIX_BUCKETS rows
            stats[k, r[name]] = r["n"], r["b"]
    sample = sampled(labelled.select("page_id", "label", "suffix1", "suffix2", *FEATURES), "label", sample_rows, 31, "page_id").collect()
    model = UrlModel(stats, None)
    y = np.array([r["label"] for r in sample], float)
    if len(y) and 0 < y.mean() < 1:
        x = model.matrix(np.array([[r[f] for f in FEATURES] for r in sample]), np.array([r["suffix1"] for r in sample]), np.array([r["suffix2"] for r in sample]))
        model.trees = Boosted().fit(x, y)
    return model


def judged(pages: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.  URLs that a
    rule decides are the labelled ones."""
    ship(pages.sparkSession)
    host, path = parts(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    urls = features(urls.withColumns({"rule": rule, "verdict": verdict}))
    labelled = urls.where(F.col("rule").isNotNull()).withColumn("label", (F.col("verdict") == "block").cast("int"))
    model = train(labelled, sample_rows)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            score = np.zeros(batch.num_rows)
            if model.trees is not None and batch.num_rows:
                score = model.trees.predict(model.matrix(np.stack([col(f) for f in FEATURES], 1), col("suffix1"), col("suffix2")))
            made = np.where(score >= 0.5, "block", "allow").tolist()
            verdict = [v or m for v, m in zip(batch.column("verdict").to_pylist(), made, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page_id", "host", "path", "rule")], pa.array(verdict, pa.string()), pa.array(score)], ["page_id", "host", "path", "rule", "verdict", "score"])

    return urls.mapInArrow(run, f"page_id {urls.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string, score double")
