"""Exact n-gram Jaccard self-join with token-combination prefixes.

A document is its set of distinct k-word shingles (64-bit hashes).  Documents
of one set form a class, so copies are joined once.  Every shingle falls into
one of 2**20 token classes, counted over all documents; a class far above the
mean count is frequent.  Tokens are ordered rare first, then by hash.

* A rare token among the first n - ceil(t n) + 1 of a set is indexed alone.
* Where that prefix reaches frequent tokens, it is extended, and each pair of
  tokens that are neighbours in the set's frequent part is indexed instead:
  the first n // 2 - 2 * rare + 1 pairs.  If two linked sets share no rare
  token, every unshared token of the one breaks at most two of its pairs and
  every unshared token of the other at most one, which leaves an unbroken
  pair within that extension on both sides (for t = 3/4), so no link is lost.

Candidates pass a size and a position bound and are verified on the whole
texts.  Only components are returned, so a signature's members are first
compared with its first ``HUBS`` members; only where members of a larger
group are then still apart are the remaining pairs between different
components compared, so near copies of one text are not paired off.  Before
whole texts are fetched, a pair's sketches (parity bits of each set's hashes)
must allow the link; the bound is exact, never an estimate.

Defined results: null, empty and wordless texts have an empty set and are
linked with nothing; fewer than k words are one shingle; repeated rows are
returned each; a null doc_id takes part, but names a component only if no
other id does; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import keyed, written
from elcorpus.llm.components import components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union; the pair extension is proved for 75 and more.
PERCENT = 75
TOKEN_CLASS_BITS = 20
CHUNKS = 64
#: Members of a signature with which all its members are compared first.
HUBS = 8
#: Comparisons of a hub in one salted group.
GROUP_ROWS = 256
#: Rows of 64 bits in a broadcast filter of wanted keys, at most.
FILTER_WORDS = 1 << 18


def set_hash(s: np.ndarray) -> int:
    """One number for a set of shingles."""
    with np.errstate(over="ignore"):
        return int(T.mix(np.array([T.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def parities(s: np.ndarray) -> np.ndarray:
    """The set's sketch: for each value of the hashes' last bits, whether an
    odd number of them has it.  It has 1 to 2 bits a shingle, 64 at least."""
    width = max(64, 1 << (len(s) - 1).bit_length()) if len(s) else 64
    return np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8), bitorder="little")


def _classes(docs: DataFrame, k: int) -> DataFrame:
    """A row (doc_id, n, h, sketch) for each document and, from each task,
    rows (chunk, counts) of its token-class counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TOKEN_CLASS_BITS, np.int64)
        kind, names = None, ["doc_id", "n", "h", "sketch", "chunk", "counts"]
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            n, h, sketch = [], [], []
            for _, _, words in T.texts_of(batch, T.SPACE_WORDS):
                sets = list(T.shingles(words, k))
                counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - TOKEN_CLASS_BITS)).astype(np.int64), minlength=len(counts))
                n += [len(s) for s in sets]
                h += [set_hash(s) for s in sets]
                sketch += [parities(s).tobytes() for s in sets]
            none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(h, pa.int64()), pa.array(sketch, pa.binary()), *none], names)
        if kind is not None:
            parts = [x.astype("<i8").tobytes() for x in counts.reshape(CHUNKS, -1)]
            yield pa.RecordBatch.from_arrays([pa.nulls(CHUNKS, kind), pa.nulls(CHUNKS, pa.int64()), pa.nulls(CHUNKS, pa.int64()), pa.nulls(CHUNKS, pa.binary()), pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, h long, sketch binary, chunk int, counts binary")


def _frequent(classes: DataFrame) -> np.ndarray:
    """A flag for each token class: its count is far above the mean."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                own = np.frombuffer(counts.as_buffer(), "<i8")
                total[chunk] = total[chunk] + own if chunk in total else own
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "counts"])

    counts = np.zeros((CHUNKS, (1 << TOKEN_CLASS_BITS) // CHUNKS), np.int64)
    rows = classes.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    for r in rows.toLocalIterator():  # CHUNKS rows of fixed size
        counts[r["chunk"]] = np.frombuffer(r["counts"], "<i8")
    mean = counts.mean()
    return counts.ravel() > mean + 8 * np.sqrt(mean) + 32


def signatures(s: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures, their positions, rare tokens) of a set's sorted hashes."""
    often = frequent[(s >> np.uint64(64 - TOKEN_CLASS_BITS)).astype(np.int64)]
    rare, n = s[~often], len(s)
    prefix = n + (-n * percent // 100) + 1  # n - ceil(t n) + 1
    single = rare[:prefix]
    out, at = [T.mix(single)], [np.arange(len(single))]
    if len(rare) < prefix:
        f = s[often]
        pairs = min(len(f) - 1, n // 2 - 2 * len(rare) + 1)
        if pairs > 0:
            out.append(T.mix(f[:pairs] * np.uint64(0x9FB21C651E98DF25) + f[1:pairs + 1]) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            at.append(len(rare) + np.arange(pairs))
    return np.concatenate(out), np.concatenate(at), len(rare)


def _postings(docs: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """(sig, h, n, i, rare): a row for each signature of each set; a task
    gives equal sets once."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = np.unpackbits(shared.value).astype(bool), set()
        for batch in batches:
            for _, _, words in T.texts_of(batch, T.SPACE_WORDS):
                sigs, at, meta = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
                for s in T.shingles(words, k):
                    if len(s) == 0 or (h := set_hash(s)) in seen:
                        continue
                    if len(seen) >= 500_000:  # equal sets given twice do no harm
                        seen.clear()
                    seen.add(h)
                    sig, i, rare = signatures(s, often, percent)
                    sigs.append(sig)
                    at.append(i)
                    meta.append((h, len(s), rare, len(sig)))
                m = np.array(meta, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.repeat(m[:, 0], m[:, 3])), pa.array(np.repeat(m[:, 1], m[:, 3]).astype(np.int32)), pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.repeat(m[:, 2], m[:, 3]).astype(np.int32))], ["sig", "h", "n", "i", "rare"])

    return docs.select("text").mapInArrow(run, "sig long, h long, n int, i int, rare int")


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Over each signature's members in the order of h: rows (a, b) of the
    first HUBS members with all, and rows (sig, h, n, i, rare) of the members
    of groups that this does not pair completely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)  # the last group's first rows; whether they are given already
        given = False
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sig", "h", "n", "i", "rare")], 1)
            old = len(held)
            skip = old if old and len(rows) and rows[0, 0] == held[0, 0] else 0
            rows = np.concatenate([held[:skip], rows])
            if len(rows) == 0:
                continue
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            fresh = np.arange(len(rows)) >= skip
            rows, fresh = rows[new], fresh[new]
            begin = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
            start = np.maximum.accumulate(np.where(begin, np.arange(len(rows)), 0))
            place = np.arange(len(rows)) - start
            size = np.diff(np.r_[np.flatnonzero(begin), len(rows)])[np.cumsum(begin) - 1]
            pairs = []
            for k in range(HUBS):
                b = np.flatnonzero(fresh & (place > k))
                a = start[b] + k
                x, y = rows[a], rows[b]
                ok = _possible(x[:, 2], x[:, 3], x[:, 4], y[:, 2], y[:, 3], y[:, 4], percent)
                pairs.append(np.stack([x[ok, 1], y[ok, 1]], 1))
            pairs = np.unique(np.concatenate(pairs), axis=0)
            big = size > HUBS + 1
            first_group = start == 0
            give = big & (fresh | (first_group & (skip > 0) & (not given)))
            posts = rows[give]
            n = len(pairs), len(posts)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[pairs[:, 0], posts[:, 1]], pa.int64()), pa.concat_arrays([pa.array(pairs[:, 1], pa.int64()), pa.nulls(n[1], pa.int64())]), *[pa.concat_arrays([pa.nulls(n[0], t), pa.array(posts[:, c]).cast(t)]) for c, t in ((0, pa.int64()), (2, pa.int32()), (3, pa.int32()), (4, pa.int32()))]], ["a", "b", "sig", "n", "i", "rare"])
            last = start == start[-1]
            given = bool(big[-1]) or (given and skip > 0 and start[-1] == 0)
            held = rows[last][:HUBS + 2]

    ordered = postings.repartition("sig").sortWithinPartitions("sig", "h")
    return ordered.mapInArrow(run, "a long, b long, sig long, n int, i int, rare int")


def _possible(n, i, ra, m, j, rb, percent: int) -> np.ndarray:
    """Size and position bounds on the overlap, given one shared signature.
    Pairs of tokens count only for sets that share no rare token."""
    single = np.minimum(i, j) + np.minimum(n - i, m - j)
    pair = np.minimum(i - ra, j - rb) + np.minimum(n - i, m - j)
    most = np.where((i < ra) & (j < rb), single, pair)
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (100 * most >= percent * (n + m - most))


def _possible_sql(percent: int):
    single = "(least(x.i, y.i) + least(x.n - x.i, y.n - y.i))"
    pair = "(least(x.i - x.rare, y.i - y.rare) + least(x.n - x.i, y.n - y.i))"
    most = f"(case when x.i < x.rare and y.i < y.rare then {single} else {pair} end)"
    return F.expr(f"100L * least(x.n, y.n) >= {percent}L * greatest(x.n, y.n) and 100L * {most} >= {percent}L * (x.n + y.n - {most})")


def _sketches_allow(x: np.ndarray, n: int, y: np.ndarray, m: int, percent: int) -> bool:
    """Whether two sets can be linked: where their parities differ, a
    shingle is in one of the sets alone.  The wider sketch is folded."""
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    most = (n + m - int(np.bitwise_count(x ^ y).sum())) // 2
    return 100 * most >= percent * (n + m - most)


def _compared(pairs: DataFrame, payload: DataFrame, on, columns: list[str], read, allow) -> DataFrame:
    """The pairs (a, b) that ``allow`` accepts.  What b brings comes to a's,
    in salted groups of a; in a group a's own row is first, the others
    stream by.  ``read`` yields (row, payload or None) of a batch."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("salts"))
    named = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    wanted = named.select("a", F.col("b").alias("h"), "salt", F.lit(1).alias("kind")).unionByName(named.select("a", F.col("a").alias("h"), "salt", F.lit(0).alias("kind")).distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub = None, None
        for batch in batches:
            a, h, salt, kind = (batch.column(c).to_pylist() for c in ("a", "h", "salt", "kind"))
            out = []
            for row, own in read(batch, h):
                if own is None:
                    continue
                if kind[row] == 0:
                    key, hub = (a[row], salt[row]), own
                elif key == (a[row], salt[row]) and allow(hub, own):
                    out.append((a[row], h[row]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    grouped = on(wanted, payload).select("a", "salt", "kind", "h", *columns).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def _narrowed(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` (null is a value) is not
    in ``wanted``, before anything is exchanged: a bit for the hash of each
    wanted key, in at most FILTER_WORDS broadcast rows whatever the data.
    Where the bits fill up, rows pass that the join after it drops."""
    at = f"pmod(xxhash64({key}), {64 * FILTER_WORDS}L)"
    words = wanted.selectExpr(f"cast({at} div 64 as int) as word", f"shiftleft(1L, cast({at} % 64 as int)) as bits").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    return rows.join(F.broadcast(words), F.expr(f"cast({at} div 64 as int) = word and getbit(bits, cast({at} % 64 as int)) = 1"), "left_semi")


def _by_sketch(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow a link."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    sketches = _narrowed(classes.where("n > 0"), "h", wanted).join(wanted, "h").select("h", "n", "sketch").dropDuplicates(["h"])

    def read(batch, h):
        for row, (n, x) in enumerate(zip(batch.column("n").to_pylist(), batch.column("sketch"), strict=True)):
            yield row, (np.frombuffer(x.as_buffer(), np.uint8), n)

    return _compared(pairs, sketches, lambda w, p: w.join(p, "h"), ["n", "sketch"], read, lambda x, y: _sketches_allow(*x, *y, percent))


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their whole texts."""

    def read(batch, h):
        for i, j, words in T.texts_of(batch, T.SPACE_WORDS):
            for row, s in zip(range(i, j), T.shingles(words, k), strict=True):
                yield row, s if set_hash(s) == h[row] else None  # None: another row of a repeated id

    def linked(x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def on(wanted, texts):
        named = written(wanted.join(reps, "h").select("a", "salt", "kind", "h", "rep"), "wanted")
        texts = _narrowed(texts, "doc_id", named.select(F.col("rep").alias("doc_id")))
        return texts.join(named, texts["doc_id"].eqNullSafe(named["rep"]))

    return _compared(pairs, docs.select("doc_id", "text"), on, ["text"], read, linked)


def near_duplicates(documents: DataFrame, k: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    if percent < PERCENT:
        raise ValueError(f"the pair extension needs a similarity of {PERCENT} % or more")
    docs = keyed(documents, id_col, text_col).drop("row_key")
    classes = written(_classes(docs, k), "classes")
    rows = classes.where("chunk is null").select("doc_id", "n", "h")
    reps = written(rows.where("n > 0").groupBy("h").agg(F.min("doc_id").alias("rep")), "reps")
    found = written(_candidates(_postings(docs, _frequent(classes), k, percent), percent), "candidates")
    first = written(found.where("sig is null").select("a", "b").distinct(), "pairs")
    links = written(_verified(written(_by_sketch(first, classes, percent), "likely"), reps, docs, k, percent), "links")
    near = written(components(links), "near")
    # members of larger groups that are still apart
    members = found.where("sig is not null").select("sig", F.col("a").alias("h"), "n", "i", "rare")
    members = members.join(near, F.col("h") == F.col("node"), "left").select("sig", "h", "n", "i", "rare", F.coalesce("component", "h").alias("c"))
    apart = members.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("sig")
    apart = written(members.join(apart, "sig"), "apart")
    x, y = apart.alias("x"), apart.alias("y")
    rest = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.h") < F.col("y.h")) & (F.col("x.c") != F.col("y.c")) & _possible_sql(percent)).select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct()
    rest = written(rest.join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.unionByName(_verified(written(_by_sketch(rest, classes, percent), "likely"), reps, docs, k, percent))
        near = written(components(links), "near")
    named = reps.join(near, F.col("h") == F.col("node"), "left").select("h", "rep", F.coalesce("component", "h").alias("c"))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    of_class = written(named.join(least, "c").select("h", "component_id"), "components")
    return rows.join(of_class, "h", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


#: DuckDB SQL for ``near_duplicates`` with the default parameters.
ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w),
n as (select doc_id, len(s) as n from s),
t as (select doc_id, unnest(s) as g from s),
p as (select x.doc_id as a, y.doc_id as b, count(*) as o from t x join t y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * o >= 75 * (na.n + nb.n - o)),
r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
select n.doc_id, cast(n.n as bigint) as n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) as component_id from n left join r on r.a = n.doc_id group by n.doc_id, n.n
"""
