"""Spelling variants of words, by a dictionary of pairs of trie nodes.

The distinct words are numbered into two tries, one of the words and one of
the reversed words: a range partitioning sorts them, every task numbers the
nodes that its words open, and nodes that a partition shares with the one
before it (the path of its first word) are set right from the partitions'
first and last words.  A word with code points ``c0 .. cL-1`` then has a
prefix node and a suffix node at each position, and

* the pair (prefix before i, suffix after i) skips position i,
* the pair (prefix before i, suffix from i) skips nothing.

Two words that meet in a skipping pair differ by one replaced code point; a
skipping pair that meets a full one gives an insertion.  In a run of equal
code points only the last is skipped for insertions, so each pair of near
words meets exactly once.  A pair names one string with one free place: a
group has at most one member for each letter and one full word, so it is
bounded by the alphabet.

Node numbers of the words rise in code-point order, and a word is known by
the number of its last node, so all joins are on integers.

Defined results: null and empty texts have no words; a null id counts as the
empty text in the crc32; repeated rows count each; words of any length are
read whole; ties of the largest n go to the smallest word; an empty table
gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm.common import ship, shuffle_parts, written

LEAST_POINTS, LEAST_COUNT, FACTOR, DELETE_EVERY = 7, 2, 10, 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(documents: DataFrame, least: int = LEAST_POINTS, every: int = DELETE_EVERY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) of every run; a run whose crc32 with the id is divisible by
    ``every`` loses one code point."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # a run's result has at most its own length, so shorter runs never count
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(f"([a-zÀ-ÿ]{{{least},}})"), 0)
    out = documents.select(key.alias("key"), F.explode(runs).alias("run"))
    h, at = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")), F.col("at")
    out = out.select("run", h.alias("h")).select("run", (F.col("h") % every == 0).alias("cut"), (F.col("h") % F.length("run")).cast("int").alias("at"))
    word = F.when(F.col("cut"), F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return out.select(word.alias("word")).where(F.length("word") >= least)


def dictionary(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while a[lo] == b[lo]:
        lo += 1
    return lo


#: Code points handled at once (a longer word alone).
BLOCK_POINTS = 1 << 20


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows whose words have few code points."""
    for batch in batches:
        first, size = 0, 0
        for i, points in enumerate(pc.utf8_length(batch.column("word")).to_pylist()):
            if size and size + points > BLOCK_POINTS:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += points
        if first < batch.num_rows:
            yield batch.slice(first)


def _numbered(words: DataFrame, key: str, part: str, path: str, name: str) -> DataFrame:
    """``words``, sorted by ``key`` over range partitions and written, with
    the partition and the numbers of the key's trie nodes in it (from 1; the
    first key's nodes come first)."""
    schema = f"{part} int, {path} array<int>"
    kept = [c for c in words.columns if c != "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last, nodes, top = TaskContext.get().partitionId(), "", [], 0
        for part_rows in _blocks(batches):
            paths = []
            for word in part_rows.column("word").to_pylist():
                own = word if key == "word" else word[::-1]
                m = common_prefix(last, own)
                nodes = nodes[:m] + list(range(top + 1, top + 1 + len(own) - m))
                top += len(own) - m
                last = own
                paths.append(nodes)
            yield pa.RecordBatch.from_arrays([*part_rows.columns, pa.array([index] * len(paths), pa.int32()), pa.array(paths, pa.list_(pa.int32()))], ["word", *kept, part, path])

    by = F.col("word") if key == "word" else F.reverse("word")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.select("word", *kept).schema)
    rows = words.select("word", *kept).repartitionByRange(shuffle_parts(words.sparkSession), by).sortWithinPartitions(by)
    return written(rows.mapInArrow(run, f"{types}, {schema}"), name)


def joints(rows: DataFrame, key: str, part: str, path: str) -> dict[int, tuple[int, list[int]]]:
    """Partition -> (number before its own nodes, numbers of the nodes that
    it shares with partitions before it).  Reads a row for each partition:
    its first and last key, the nodes of the last one and its size."""
    by = F.col("word") if key == "word" else F.reverse("word")
    ends = rows.groupBy(part).agg(F.min(by).alias("a"), F.max(F.struct(by.alias("k"), F.col(path).alias("p"))).alias("z"), F.max(F.array_max(path)).alias("top"))
    out, last, numbers, base = {}, "", [], 0
    for r in ends.orderBy(part).toLocalIterator():
        m = common_prefix(last, r["a"])
        shared = numbers[:m]
        out[r[part]] = (base - m, shared)  # node x of the partition: base - m + x if x > m
        last = r["z"]["k"]
        numbers = [shared[x - 1] if x <= m else base - m + x for x in r["z"]["p"]]
        base += r["top"] - m
    return out


def pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((p, s, mid, id, n), (id, word, n)): the pairs of nodes of every word
    of (word, n), and the words by number.  ``mid`` is the skipped code
    point, negative if the next one is equal, 0 where nothing is skipped."""
    spark = words.sparkSession
    ship(spark)
    forward = _numbered(words, "word", "fpart", "fpath", "spelling-forward")
    both = _numbered(forward, "reversed", "rpart", "rpath", "spelling-both")
    ends = spark.sparkContext.broadcast((joints(forward, "word", "fpart", "fpath"), joints(both, "reversed", "rpart", "rpath")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fends, rends = ends.value
        for batch in _blocks(batches):
            p, s, mid, ids, n = [], [], [], [], []

            def block():
                out = pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(s, pa.int64()), pa.array(mid, pa.int16()), pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["p", "s", "mid", "id", "n"])
                for x in (p, s, mid, ids, n):
                    x.clear()
                return out

            for word, count, fp, f, rp, r in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "fpart", "fpath", "rpart", "rpath")), strict=True):
                f, r, size = [0, *_placed(f, fends[fp])], [0, *_placed(r, rends[rp])], len(word)
                code = word.encode("latin-1")
                r.reverse()  # r[i]: the suffix from i on
                p += f[:-1]
                s += r[1:]
                mid += [-c if c == d else c for c, d in zip(code, code[1:] + b"\0", strict=True)]
                p += f
                s += r
                mid += [0] * (size + 1)
                ids += [f[-1]] * (2 * size + 1)
                n += [count] * (2 * size + 1)
                if len(p) > 1 << 18:
                    yield block()
            if p:
                yield block()

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fends = ends.value[0]
        for batch in batches:
            ids = [_placed(f[-1:], fends[fp])[0] for fp, f in zip(batch.column("fpart").to_pylist(), batch.column("fpath").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column("word"), batch.column("n")], ["id", "word", "n"])

    known = forward.select("word", "n", "fpart", F.slice("fpath", -1, 1).alias("fpath")).mapInArrow(ids_of, "id long, word string, n long")
    return both.mapInArrow(run, "p long, s long, mid short, id long, n long"), known


def _placed(path: list[int], end: tuple[int, list[int]]) -> list[int]:
    """Numbers over all partitions of a partition's own numbers."""
    base, shared = end
    m = len(shared)
    return [base + x if x > m else shared[x - 1] for x in path]


def near_words(pair_rows: DataFrame) -> DataFrame:
    """(id, n_near, best): the number of near words and the one of the
    largest n (smallest id in ties), as (n, -id)."""
    groups = pair_rows.groupBy("p", "s").agg(F.collect_list(F.struct("mid", "id", "n")).alias("members")).where(F.size("members") > 1)
    each = groups.select("members", F.explode("members").alias("m"))
    # two skipped places: replaced; a skipped and none: inserted, by the last of a run
    near = F.expr("filter(members, x -> x.id != m.id and ((x.mid != 0 and m.mid != 0) or x.mid + m.mid > 0))")
    each = each.select(F.col("m.id").alias("id"), near.alias("near")).where(F.size("near") > 0)
    best = F.expr("array_max(transform(near, x -> struct(x.n as n, -x.id as minus_id)))")
    return each.select("id", F.size("near").cast("long").alias("k"), best.alias("best")).groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame, largest: int, factor: int = FACTOR) -> DataFrame:
    """(id, root) of every row (id, form_id) with a form: forms are followed
    to the last by doubling the step.  A step multiplies n by ``factor``, so
    ``largest`` bounds their number."""
    out = forms.select("id", F.col("form_id").alias("root"))
    steps = max(1, math.ceil(math.log(max(2, largest), factor)))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        out = written(out, "spelling-roots")
        further = out.select(F.col("id").alias("root"), F.col("root").alias("next"))
        out = out.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    return out


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = dictionary(words_of(documents, id_col=id_col, text_col=text_col))
    pair_rows, known = pairs(written(words, "spelling-words"))  # the range partitioning reads it twice
    near = near_words(pair_rows)
    near = near.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.minus_id")).alias("best_id"))
    rows = known.join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("best_n") >= factor * F.col("n"), F.col("best_n")).alias("form_n"), "best_id")
    rows = written(rows.withColumn("form_id", F.when(F.col("form_n").isNotNull(), F.col("best_id"))).drop("best_id"), "spelling-near")
    linked = rows.where(F.col("form_id").isNotNull())
    largest = linked.agg(F.max("form_n")).first()[0] or 1
    names = rows.select(F.col("id").alias("name_id"), F.col("word").alias("name"))
    found = roots(linked, largest, factor)
    linked = linked.join(found, "id")
    linked = linked.join(names, linked["form_id"] == names["name_id"]).withColumnRenamed("name", "form").drop("name_id")
    linked = linked.join(names, linked["root"] == names["name_id"]).drop("root").withColumnRenamed("name", "root")
    alone = rows.where(F.col("form_id").isNull()).withColumn("form", F.lit(None).cast("string")).withColumn("root", F.col("word"))
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return linked.select(*columns).unionByName(alone.select(*columns))
