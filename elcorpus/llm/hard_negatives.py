"""Hard negatives by anchor-clustered shared lists.

Scores are integer inner products.  Anchors are taken in blocks of bounded
size; a block's anchors of one label are grouped into cones by direction.
Every task holds a part of all rows, and for each cone it sorts its
candidates once by an upper bound on the score with any member: the
candidate's length times the cosine of its angle to the cone's axis less the
cone's half angle.  Every member walks that one list, by matrix products over
pieces of it, until the bound times its own length certifies that nothing
further can enter its results.  Tasks return their best rows, which are
merged by anchor.

A first walk finds an anchor's best rows of its own label (positives), a
second the best rows of other labels in each positive's score range.  All
rows are searched and the results are exact.

Defined results: rows with a null label, a null vector or a null, NaN or
infinite component take no part; rows with a null id have no anchor and come
last in ties; repeated ids are rows of their own (equal ids tie by their
place in the table); vectors of different lengths are read as if filled up with zeros;
labels may be any int; inner products must fit in a long (ArithmeticError
if not); an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from elcorpus.llm.common import scratch_dir, ship, written

ANCHOR_EVERY, RELABEL_EVERY, SCALE = 100, 7, 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # hundredths of the positive's score
#: Anchors sent to the tasks at once, and members of a cone.
BLOCK_ANCHORS, CONE = 4096, 48
FIRST_PIECE, LAST_PIECE = 128, 2048
#: Relative error allowed to the bounds, far above that of the arithmetic.
SLACK = 1e-9
NULL_ID = (1 << 63) - 1


def prepared(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE, relabel_every: int = RELABEL_EVERY) -> DataFrame:
    """(row, id, label, vec): the rows that take part, their label as it is
    used and whole components; ``row`` is a key of its own for each row."""
    vec = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale))
    sound = F.col(vec_col).isNotNull() & F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col(id_col) % relabel_every == 0, (F.col(label_col).cast("long") + 1) % 10).otherwise(F.col(label_col).cast("long"))
    rows = embeddings.where(F.col(label_col).isNotNull() & sound)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.alias("label"), vec.alias("vec"))


def matrix(vectors: pa.Array) -> np.ndarray:
    """A list column as float64 rows, shorter ones filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths().fill_null(0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row]] = flat
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with those of ``b``."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = widened(a, width), widened(b, width)
    top = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * width
    if top < 2.0 ** 52:  # every partial sum is a whole double
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if max((abs(x) for x in exact.flat), default=0) >= 1 << 63:
        raise ArithmeticError("an inner product does not fit in a long")
    return exact.astype(np.int64)


def lengths(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.sqrt((x * x).sum(1))


def units(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(lengths(x), 1e-300)[:, None]


class Cone:
    """Anchors of one label around an axis; ``low``/``high`` (anchors x
    ranges) bound the scores asked for, ``k`` rows for each range."""

    def __init__(self, label: int, rows: np.ndarray, vecs: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.label, self.rows, self.vecs, self.k = label, rows, vecs, k
        self.low, self.high = low, high
        unit = units(vecs)
        self.length = lengths(vecs)
        self.axis = units(unit.sum(0, keepdims=True))[0]
        inside = np.clip(unit @ self.axis, -1, 1)
        # a zero vector has no direction: its bound is 0 whatever the angle
        self.half = float(np.arccos(inside[self.length > 0].min())) + 1e-7 if (self.length > 0).any() else 0.0
        self.floor = low.astype(np.float64)  # nothing below can enter
        self.best = np.zeros((6, 0), np.int64)  # member, range, -score, id, row, label

    def bounds(self, unit: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Upper bounds on a candidate's score with a member of length 1."""
        width = max(unit.shape[1], len(self.axis))
        angle = np.arccos(np.clip(widened(unit, width) @ widened(self.axis[None], width)[0], -1, 1))
        return length * np.cos(np.maximum(0.0, angle - self.half - 1e-7))

    def walk(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, unit: np.ndarray, length: np.ndarray, same: bool) -> int:
        """Take in a part of the rows; returns the products computed."""
        mine = np.flatnonzero((labels == self.label) == same)
        bound = self.bounds(unit[mine], length[mine])
        order = np.argsort(-bound, kind="stable")
        mine, bound = mine[order], bound[order]
        at, piece, done = 0, FIRST_PIECE, 0
        members = np.arange(len(self.rows))
        while at < len(mine):
            reach = bound[at] * self.length[members]
            reach = reach + SLACK * np.abs(reach) + 1e-6
            members = members[reach >= self.floor[members].min(1)]
            if not len(members):
                break
            part = mine[at:at + piece]
            scores = products(self.vecs[members], vecs[part])
            done += scores.size
            self._take(members, scores, rows[part], ids[part], labels[part])
            at, piece = at + len(part), min(LAST_PIECE, 2 * piece)
        return done

    def _take(self, members, scores, rows, ids, labels):
        found = [self.best]
        for j in range(self.low.shape[1]):
            u, c = np.nonzero((scores >= self.floor[members, j][:, None]) & (scores <= self.high[members, j][:, None]) & (self.rows[members][:, None] != rows[None, :]))
            if len(u):
                found.append(np.stack([members[u], np.full(len(u), j), -scores[u, c], ids[c], rows[c], labels[c]]))
        if len(found) == 1:
            return
        every = np.concatenate(found, axis=1)
        every = every[:, np.lexsort((every[4], every[3], every[2], every[1], every[0]))]
        group = every[0] * self.low.shape[1] + every[1]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        self.best = every[:, rank < self.k]
        full = every[:, rank == self.k - 1]
        self.floor[full[0], full[1]] = -full[2]


def cones(label: np.ndarray, rows: np.ndarray, vecs: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, size: int = CONE) -> list[Cone]:
    """Anchors of each label halved by direction until ``size`` are left."""
    out = []
    for value in np.unique(label):
        todo = [np.flatnonzero(label == value)]
        while todo:
            own = todo.pop()
            if len(own) <= size:
                out.append(Cone(int(value), rows[own], vecs[own], low[own], high[own], k))
                continue
            unit = units(vecs[own])
            # two far members lead the halves; the median keeps them equal
            a = unit[int(np.argmin(unit @ unit[0]))]
            b = unit[int(np.argmin(unit @ a))]
            order = np.argsort(unit @ (a - b), kind="stable")
            todo += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return out


def search(items: DataFrame, anchors: pa.Table, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> DataFrame:
    """(anchor_row, rng, score, id, row): of ``items`` with the anchor's label
    (or, not ``same``, another one) the best ``k`` within each range of
    scores, an anchor's own row aside.  ``anchors`` is a block, so what is
    sent to the tasks is bounded."""
    shared = items.sparkSession.sparkContext.broadcast((anchors.column("row").to_numpy(), anchors.column("label").to_numpy(), matrix(anchors.column("vec")), low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, label, vecs, low, high = shared.value
        own = cones(label, rows, vecs, low, high, k)
        for batch in batches:
            part = matrix(batch.column("vec"))
            length, unit = lengths(part), units(part)
            ids = batch.column("id").fill_null(NULL_ID).to_numpy()
            for cone in own:
                cone.walk(batch.column("row").to_numpy(), ids, batch.column("label").to_numpy(), part, unit, length, same)
        for cone in own:
            member, rng, minus, ids, found, _ = cone.best
            yield pa.RecordBatch.from_arrays([pa.array(cone.rows[member]), pa.array(rng.astype(np.int32)), pa.array(-minus), pa.array(ids, pa.int64(), mask=ids == NULL_ID), pa.array(found)], ["anchor_row", "rng", "score", "id", "row"])

    found = items.mapInArrow(run, "anchor_row long, rng int, score long, id long, row long")
    order = Window.partitionBy("anchor_row", "rng").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def of_block(items: DataFrame, anchors: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """The result for a block of anchors."""
    n = anchors.num_rows
    whole = np.full((n, 1), -(1 << 62), np.int64)
    best = search(items, anchors, whole, -whole, positives, True).collect()  # at most ``positives`` rows an anchor
    place = {int(r): i for i, r in enumerate(anchors.column("row").to_pylist())}
    lows = np.full((n, positives), 1 << 62, np.int64)
    highs = np.full((n, positives), -(1 << 62), np.int64)
    chosen, ids = [], anchors.column("id").to_pylist()
    for r in best:
        i, j, score = place[r["anchor_row"]], r["rank"] - 1, int(r["score"])
        chosen.append((r["anchor_row"], j, ids[i], r["id"], score))
        lows[i, j], highs[i, j] = -((-low * score) // 100), (high * score) // 100
    if not chosen:
        return None
    spark = items.sparkSession
    wanted = spark.createDataFrame(chosen, "anchor_row long, rng int, anchor_id long, positive_id long, positive_score long")
    found = search(items, anchors, lows, highs, negatives, False)
    return found.join(F.broadcast(wanted), ["anchor_row", "rng"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(embeddings: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_anchors: int = BLOCK_ANCHORS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the anchors, which are the rows whose id ``every``
    divides.  Blocks are searched one after the other and written."""
    spark = embeddings.sparkSession
    ship(spark)
    items = written(prepared(embeddings, id_col, vec_col, label_col), "negatives-rows")
    anchors = items.where(F.col("id") % every == 0)
    blocks = max(1, -(-2 * anchors.count() // block_anchors))  # half full on average
    path = f"{scratch_dir(spark)}/negatives-{uuid.uuid4().hex}"
    anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(f"{path}/anchors")
    kept = spark.read.schema("row long, id long, label long, vec array<bigint>, block int").parquet(f"{path}/anchors")
    out = []
    for b in range(blocks):
        rows = kept.where(F.col("block") == b).drop("block").toArrow()
        found = of_block(items, rows, positives, negatives, low, high) if rows.num_rows else None
        if found is not None:
            found.write.mode("overwrite").parquet(f"{path}/found-{b}")
            out.append(f"{path}/found-{b}")
    return spark.read.schema(RESULT).parquet(*out) if out else spark.createDataFrame([], RESULT)


#: The same rows by comparing every anchor with all rows.
ORACLE = f"""
with rows as (
  select vec_id as id, case when vec_id % {RELABEL_EVERY} = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as vec, row_number() over (order by vec_id) as r
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, a.r as ar, b.id as other_id, b.r as br, a.label = b.label as same, cast(list_inner_product(a.vec, b.vec) as bigint) as score
  from rows a join rows b on a.id % {ANCHOR_EVERY} = 0 and a.r <> b.r
), positives as (
  select anchor_id, ar, br, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by ar order by score desc, other_id) <= {POSITIVES}
)
select p.anchor_id, p.positive_id, cast(row_number() over (partition by p.ar, p.br order by n.score desc, n.other_id) as integer) as rank,
  n.other_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on n.ar = p.ar and not n.same and {LOW} * p.positive_score <= 100 * n.score and 100 * n.score <= {HIGH} * p.positive_score
qualify row_number() over (partition by p.ar, p.br order by n.score desc, n.other_id) <= {NEGATIVES}
"""
