"""Removal of repeated byte strings with sparse suffix arrays.

Every ``WINDOW`` consecutive positions of a text give one suffix (winnowing:
the rightmost smallest hash of GRAM bytes), so each string of ``length``
bytes holds a chosen suffix at the same place wherever it occurs, with at
least ANCHOR = length - WINDOW + 1 bytes of the string from there on.  An
entry of a suffix array has the fingerprint of those ANCHOR bytes and that of
the whole neighbourhood in which strings through it may lie; arrays are kept
in fingerprint order, which brings equal strings together as content order
does.

The index is a logarithmic family: a level of rank r holds the merged arrays
of 2**r batches, and no neighbourhood is in the index twice.  A new batch's
array is merge-scanned with itself and all levels in one pass.  Entries with an equal neighbourhood are covered whole; entries with
an equal anchor only are handed to a byte-exact comparison of their
neighbourhoods (grouped by anchor; the keys of groups beyond MEMBERS rows are
shuffled instead).  What is new in the batch becomes a level of rank 0, and
two levels of one rank merge into one of the next; so an entry is written
once for each rank, log2(n) times over n batches.

Defined results: null and empty texts have no bytes and nothing removed;
repeated rows count as further occurrences, so equal texts of ``length``
bytes and more go whole; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from elcorpus.llm import textops as T
from elcorpus.llm.common import exists, keyed, removed, scratch_dir, written

LENGTH = 400
WINDOW = 128
GRAM = 32
#: Batches in which the query adds the corpus.
BATCHES = 4
#: Neighbourhoods of one anchor that are compared in one task's memory.
MEMBERS = 8192

ARRAY = ["anchor", "around", "row_key", "pos", "before", "after"]
ENTRY = "anchor long, around long, row_key long, pos long, before int, after int"


def _chosen(prefix: np.ndarray, offs: np.ndarray, anchor: int) -> np.ndarray:
    """Winnowed positions with ``anchor`` bytes of their document after them."""
    n = int(offs[-1])
    ends = np.repeat(offs[1:], np.diff(offs))
    pos = np.arange(n)
    ok = pos + GRAM <= ends
    key = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    at = pos[ok]
    key[ok] = T.span_hash(prefix, at, at + GRAM) & np.uint64(0xFFFFFFFF00000000) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
    if n < WINDOW:
        return np.zeros(0, np.int64)
    step = 1
    while step < WINDOW:  # smallest of WINDOW keys by doubling
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    low = key[np.r_[True, key[1:] != key[:-1]]]
    got = np.unique((np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64))
    got = got[got < n]
    return got[got + anchor <= ends[got]]


def entries(docs: DataFrame, length: int) -> DataFrame:
    """Suffix entries of a batch.  Of equal texts and neighbourhoods a task
    gives two; the others are marked as covered (``before`` = -1, ``pos`` the
    end and ``after`` the length of what is covered)."""
    anchor, reach = length - WINDOW + 1, WINDOW - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            data, offs = T.utf8(batch.column("text"))
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for i, j in T.slices(offs):
                own, at = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                whole, use = [], np.ones(j - i, bool)
                for k in np.flatnonzero(np.diff(at) >= length).tolist():
                    digest = hashlib.blake2b(own[at[k]:at[k + 1]], digest_size=16).digest()
                    if len(seen) >= 300_000:  # texts given again do no harm
                        seen.clear()
                    seen[digest] = seen.get(digest, 0) + 1
                    if seen[digest] > 2:
                        use[k] = False
                        whole.append(k)
                prefix = T.prefix_hash(own)
                p = _chosen(prefix, at, anchor)
                doc = np.searchsorted(at, p, "right") - 1
                p, doc = p[use[doc]], doc[use[doc]]
                before = np.minimum(reach, p - at[doc])
                after = np.minimum(reach, at[doc + 1] - p - anchor)
                some = before + after + anchor >= length
                p, doc, before, after = p[some], doc[some], before[some], after[some]
                a = T.span_hash(prefix, p, p + anchor)
                b = T.mix(T.span_hash(prefix, p - before, p + anchor + after) + before.astype(np.uint64))
                # of a neighbourhood that is here more than twice, two go on; the others are covered
                order = np.lexsort((np.arange(len(b)), b, a))
                third = np.zeros(len(b), bool)
                third[order[2:]] = (a[order[2:]] == a[order[:-2]]) & (b[order[2:]] == b[order[:-2]])
                w = np.array(whole, np.int64)
                end = np.r_[(p - at[doc] + anchor + after)[third], at[w + 1] - at[w]]
                long = np.r_[(before + anchor + after)[third], at[w + 1] - at[w]]
                row = keys[np.r_[i + doc[third], i + w].astype(np.int64)]
                spread = T.mix(row.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + end.astype(np.uint64))
                p, doc, before, after, a, b = (x[~third] for x in (p, doc, before, after, a, b))
                cols = [np.r_[a, spread].view(np.int64), np.r_[b, spread].view(np.int64), np.r_[keys[i + doc], row], np.r_[p - at[doc], end], np.r_[before, -np.ones(len(end))].astype(np.int32), np.r_[after, long].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["anchor", "around", "row_key", "pos", "before", "after"])

    return docs.select("row_key", "text").mapInArrow(run, ENTRY)


def merge_scan(array: DataFrame, level: DataFrame | None, length: int, keep: bool) -> DataFrame:
    """Over the entries of a batch and of a level in fingerprint order: kind
    0, intervals (row_key, pos, end) of entries whose neighbourhood occurs
    again; kind 1, entries to compare byte by byte; kind 2 (where ``keep``),
    the batch's array with one entry for each neighbourhood that the level
    has not."""
    anchor = length - WINDOW + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*ARRAY, "fresh"]

        def given(rows, dups, firsts, groups, given_before):
            """Output for rows with flags: occurs again; first of its
            neighbourhood; its anchor has several neighbourhoods; given
            before without the last flag."""
            out = []
            full = dups | (rows[:, 4] < 0)
            r = rows[full]
            mark = r[:, 4] < 0
            out.append((0, r, np.where(mark, r[:, 3] - r[:, 5], r[:, 3] - r[:, 4]), np.where(mark, r[:, 3], r[:, 3] + anchor + r[:, 5])))
            fine = rows[firsts & groups]
            out.append((1, fine, fine[:, 3], fine[:, 3]))
            if keep:
                one = rows[firsts & ~given_before & (rows[:, 4] >= 0) & (rows[:, 6] == 1)]
                out.append((2, one, one[:, 3], one[:, 3]))
            return out

        def batch_of(parts):
            kinds = np.concatenate([np.full(len(r), k, np.int8) for k, r, _, _ in parts])
            r = np.concatenate([r for _, r, _, _ in parts])
            lo, hi = np.concatenate([x for _, _, x, _ in parts]), np.concatenate([x for _, _, _, x in parts])
            return pa.RecordBatch.from_arrays([pa.array(kinds), *[pa.array(r[:, c]) for c in (0, 1, 2)], pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64)), pa.array(r[:, 4].astype(np.int32)), pa.array(r[:, 5].astype(np.int32))], ["kind", *names[:3], "pos", "end", "before", "after"])

        state = _Runs()
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], 1)
            if len(rows):
                got = state.feed(rows)
                if got:
                    yield batch_of(given(*got))
        got = state.end()
        if got:
            yield batch_of(given(*got))

    arrays = array.select(*ARRAY, F.lit(1).alias("fresh"))
    if level is not None:
        arrays = arrays.unionByName(level.select(*ARRAY, F.lit(0).alias("fresh")))
    ordered = arrays.repartition("anchor").sortWithinPartitions("anchor", "around", "fresh")
    return ordered.mapInArrow(run, "kind byte, anchor long, around long, row_key long, pos long, end long, before int, after int")


class _Runs:
    """Flags over a sorted stream of entries, with a constant amount held
    back: the first row of the last anchor until a second neighbourhood
    shows, and the last row until its successor is known."""

    def __init__(self):
        self.tail = None  # rows not given yet (at most two)
        self.tail_dup = None  # whether each equals its predecessor
        self.first = None  # whether each is the first of its neighbourhood
        self.several = False  # the last anchor has shown several neighbourhoods
        self.lead = None  # that anchor's first row, given already without the group flag
        self.prev = None

    def feed(self, rows: np.ndarray):
        return self._flags(rows, False)

    def end(self):
        return self._flags(np.zeros((0, 7), np.int64), True)

    def _flags(self, new: np.ndarray, last: bool):
        rows = new if self.tail is None else np.concatenate([self.tail, new])
        if len(rows) == 0:
            return None
        same = np.zeros(len(rows), bool)
        same[1:] = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
        if self.prev is not None:
            same[0] = rows[0, 0] == self.prev[0] and rows[0, 1] == self.prev[1]
        begin = np.ones(len(rows), bool)
        begin[1:] = rows[1:, 0] != rows[:-1, 0]
        begin[0] = self.prev is None or rows[0, 0] != self.prev[0]
        dup = same.copy()
        dup[:-1] |= same[1:]
        firsts = ~same
        # several neighbourhoods: some row of the anchor here is first but doesn't begin it
        group = np.cumsum(begin)
        more = np.zeros(group[-1] + 1, bool)
        more[group[firsts & ~begin]] = True
        if self.several and not begin[0]:
            more[0] = True
        groups = more[group]
        lead, extra = self.lead, None
        if lead is not None and not begin[0] and more[0] and not self.several:
            extra = lead  # now known to need the comparison
        cut = len(rows) if last else len(rows) - 1  # the last row waits for its successor
        out = rows[:cut], dup[:cut], firsts[:cut], groups[:cut], np.zeros(cut, bool)
        if cut:
            self.prev = rows[cut - 1]
            starts = np.flatnonzero(begin[:cut])
            if len(starts):
                self.lead = rows[starts[-1]]
                self.several = bool(groups[starts[-1]]) and bool((firsts[:cut] & ~begin[:cut] & (group[:cut] == group[cut - 1])).any())
                if groups[starts[-1]]:
                    self.several = True
            else:
                self.several = self.several or bool(more[0])
        self.tail = None if last else rows[cut:]
        if extra is not None:  # given again with the group flag only
            out = (np.concatenate([extra[None], out[0]]), np.r_[False, out[1]], np.r_[True, out[2]], np.r_[True, out[3]], np.r_[True, out[4]])
        return out if len(out[0]) else None


class SuffixIndex:
    """Levels of suffix arrays by rank, the largest first, no two with a
    neighbourhood in common; ``add`` reports what a batch shares with itself
    and with all earlier ones.  All tables lie in one folder of the shared
    one; an array is removed when the level that it went into is written."""

    def __init__(self, spark: SparkSession, length: int = LENGTH):
        self.spark, self.length = spark, length
        self.folder = f"{scratch_dir(spark)}/suffixes-{uuid.uuid4().hex}"
        self.levels: list[tuple[int, str]] = []
        self.tables = 0

    def table(self, df: DataFrame, *by: str) -> str:
        """The path of ``df``, written as the folder's next table."""
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        df.write.partitionBy(*by).parquet(path)
        return path

    def level(self, path: str) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(path)

    def add(self, docs: DataFrame, more: bool = True) -> DataFrame:
        """Scan a batch (row_key, text) against itself and the levels;
        ``more``: keep it as a level for later batches."""
        levels = [self.level(path) for _, path in self.levels]
        scan = merge_scan(entries(docs, self.length), functools.reduce(DataFrame.unionByName, levels) if levels else None, self.length, more)
        path = self.table(scan.withColumn("part", F.col("kind")), "part")
        if more and exists(self.spark, f"{path}/part=2"):
            self._keep(f"{path}/part=2")
        found = [self.spark.read.schema(scan.schema).parquet(p) for k in (0, 1) if exists(self.spark, p := f"{path}/part={k}")]
        return functools.reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], scan.schema)

    def _keep(self, path: str) -> None:
        """A level of rank 0; two of one rank merge into one of the next."""
        rank, paths = 0, [path]
        while self.levels and self.levels[-1][0] == rank:
            paths.append(self.levels.pop()[1])
            rank += 1
        if rank:
            path = self.table(functools.reduce(DataFrame.unionByName, map(self.level, paths)).repartition("anchor").sortWithinPartitions("anchor", "around"))
            for old in paths:
                removed(self.spark, old)
        self.levels.append((rank, path))


def _neighbourhoods(docs: DataFrame, fine: DataFrame, length: int) -> DataFrame:
    """(anchor, row_key, pos, before, after, left, right) bytes around entries."""
    anchor = length - WINDOW + 1
    wanted = fine.groupBy("row_key").agg(F.collect_list(F.struct("pos", "anchor", "before", "after")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, at in zip(batch.column("row_key").to_pylist(), batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True):
                raw = text.encode()
                for x in at:
                    p, b, a = x["pos"], x["before"], x["after"]
                    out.append((x["anchor"], key, p, b, a, raw[p - b:p][::-1], raw[p + anchor:p + anchor + a]))
            for s in range(0, len(out), 20_000):
                cols = list(zip(*out[s:s + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["anchor", "row_key", "pos", "before", "after", "left", "right"])

    return docs.join(wanted, "row_key").select("row_key", "text", "at").mapInArrow(run, "anchor long, row_key long, pos long, before int, after int, left binary, right binary")


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """For each neighbourhood and each distance d of a string's start before
    the anchor, a hash of the string's bytes; and whether it lies within."""
    n, reach = batch.num_rows, WINDOW - 1
    powers = T.powers(WINDOW)

    def hashes(column: str, size: np.ndarray) -> np.ndarray:
        padded = np.zeros((n, reach), np.uint8)
        data, offs = batch.column(column).buffers()[2], np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset:][:n + 1]
        if data is not None and offs[-1] > offs[0]:
            flat = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]]
            row = np.repeat(np.arange(n), size)
            padded[row, np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], size)] = flat
        out = np.zeros((n, WINDOW), np.uint64)
        np.cumsum(T.BYTE_HASH[padded] * powers[:reach], axis=1, dtype=np.uint64, out=out[:, 1:])
        return out

    before, after = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("before", "after"))
    left, right = hashes("left", before), hashes("right", after)
    d = np.arange(WINDOW)
    keys = T.mix(T.mix(left) * np.uint64(0x9FB21C651E98DF25) + right[:, ::-1] + batch.column("anchor").to_numpy(zero_copy_only=False).view(np.uint64)[:, None])
    return keys, (d[None, :] <= before[:, None]) & (reach - d[None, :] <= after[:, None])


def _fine(around: DataFrame, index: SuffixIndex, members: int) -> DataFrame:
    """Intervals (row_key, pos, end) of the strings of ``length`` bytes that
    occur in another neighbourhood of the same anchor."""
    names, length = ["anchor", "row_key", "pos", "before", "after", "left", "right"], index.length

    def intervals(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, ok = _keys(batch)
        hit = np.zeros(keys.shape, bool)
        for d in range(WINDOW):
            use = np.flatnonzero(ok[:, d])
            order = use[np.argsort(keys[use, d], kind="stable")]
            k = keys[order, d]
            twin = np.zeros(len(k), bool)
            twin[1:] = k[1:] == k[:-1]
            twin[:-1] |= twin[1:].copy()
            hit[order[twin], d] = True
        rows = np.flatnonzero(hit.any(1))
        lo = hit[rows].argmax(1)
        hi = WINDOW - 1 - hit[rows][:, ::-1].argmax(1)
        pos = batch.column("pos").to_numpy(zero_copy_only=False)[rows]
        return pa.RecordBatch.from_arrays([pa.nulls(len(rows), pa.int64()), batch.column("row_key").take(pa.array(rows)), pa.array(pos - hi), pa.array(pos - lo + length)], ["key", "row_key", "pos", "end"])

    def single(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in range(0, batch.num_rows, 2000):
            part = batch.slice(s, 2000)
            keys, ok = _keys(part)
            row, d = np.nonzero(ok)
            start = part.column("pos").to_numpy(zero_copy_only=False)[row] - d
            yield pa.RecordBatch.from_arrays([pa.array(keys[row, d].view(np.int64)), part.column("row_key").take(pa.array(row)), pa.array(start), pa.array(start + length)], ["key", "row_key", "pos", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        large = None  # the anchor whose rows go out singly
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if large is not None:
                a = now.column("anchor").to_numpy()
                n = int(np.searchsorted(a != large, True)) if len(a) and a[0] == large else 0
                for part in now.slice(0, n).combine_chunks().to_batches():
                    yield from single(part)
                if n == len(a):
                    continue
                now, large = now.slice(n), None
            held = now if held is None else pa.concat_tables([held, now])
            a = held.column("anchor").to_numpy()
            if len(a) == 0:
                continue
            cut = int(np.flatnonzero(np.r_[True, a[1:] != a[:-1]])[-1])
            for part in held.slice(0, cut).combine_chunks().to_batches():
                yield intervals(part)
            held = held.slice(cut)
            if held.num_rows > members:
                large = int(a[-1])
                for part in held.combine_chunks().to_batches():
                    yield from single(part)
                held = None
        if held is not None and held.num_rows:
            yield intervals(held.combine_chunks().to_batches()[0])

    kind = "key long, row_key long, pos long, end long"
    path = index.table(around.select(names).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, kind))
    found = index.spark.read.schema(kind).parquet(path)
    single_keys = found.where("key is not null")
    again = single_keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return found.where("key is null").select("row_key", "pos", "end").unionByName(single_keys.join(again, "key").select("row_key", "pos", "end"))


def batched(docs: DataFrame, batches: int) -> DataFrame:
    """``docs`` (row_key, doc_id, text) written once, in a folder for each
    batch: keys stay what they are however often rows are read, also when
    the source would be split otherwise, and a batch reads its rows alone."""
    path = f"{scratch_dir(docs.sparkSession)}/batches-{uuid.uuid4().hex}"
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("row_key"), F.lit(batches)).cast("int"))
    dealt.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


def repeated(documents: DataFrame, index: SuffixIndex, batches: int = BATCHES, members: int = MEMBERS) -> DataFrame:
    """Intervals (row_key, pos, end) of documents (row_key, text, batch)
    covered by strings of the index's length that also start elsewhere; they
    are read from tables in the index's folder."""
    parts = []
    for k in range(batches):
        parts.append(index.add(documents.where(F.col("batch") == k), k + 1 < batches))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    fine = found.where("kind = 1").select("anchor", "row_key", "pos", "before", "after").distinct()
    covered = found.where("kind = 0").select("row_key", "pos", "end")
    return covered.unionByName(_fine(_neighbourhoods(documents, fine, index.length), index, members))


def remove_repeats(documents: DataFrame, length: int = LENGTH, batches: int = BATCHES, members: int = MEMBERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row;
    spans: the removed runs as little-endian int64 pairs of byte offsets."""
    if length <= WINDOW + GRAM:
        raise ValueError(f"strings of more than {WINDOW + GRAM} bytes are needed")
    docs = batched(keyed(documents, id_col, text_col), batches)
    index = SuffixIndex(documents.sparkSession, length)
    spans = written(repeated(docs, index, batches, members).groupBy("row_key").agg(F.collect_list(F.struct("pos", "end")).alias("cover")), "spans")
    removed(documents.sparkSession, index.folder)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cover in zip(batch.column("text"), batch.column("cover"), strict=True):
                raw = (text.as_py() or "").encode()
                runs = np.zeros((0, 2), np.int64)
                if cover.is_valid:
                    x = np.stack([cover.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1)
                    x = x[np.argsort(x[:, 0], kind="stable")]
                    reach = np.maximum.accumulate(x[:, 1])
                    begins = np.r_[True, x[1:, 0] > reach[:-1]]
                    runs = np.stack([x[begins, 0], reach[np.r_[begins[1:], True]]], 1)
                sha, at = hashlib.sha256(), 0
                for a, b in runs.tolist():
                    sha.update(raw[at:a])
                    at = b
                sha.update(raw[at:])
                out.append((len(raw), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), sha.hexdigest(), runs.astype("<i8").tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return docs.join(spans, "row_key", "left").select("doc_id", "text", "cover").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary")
